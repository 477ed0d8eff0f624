"""End-to-end plans: jobs (stream + batch), companies, page ingest."""

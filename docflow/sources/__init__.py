"""Document sources: collection scans, document streams, API pages, change feeds."""

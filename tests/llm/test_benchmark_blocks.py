"""A benchmark of several blocks is cut into windows by tasks and gives the results of one block."""

import os
from collections import Counter

from docflow.llm import decontaminate


def test_blocks_are_made_by_tasks(spark, documents, monkeypatch, tmp_path):
    items = [(i, " ".join(f"w{j}" for j in range(7 * i, 7 * i + 15))) for i in range(20)] + [(3, "two words"), (None, "Two Words"), (50, None), (51, "")]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    docs = documents([(1, " ".join(f"w{i}" for i in range(60))), (2, "only two words here"), (3, None), (4, "w1 w2 w3")] + [(5, "w7 " * 40)])
    want = Counter(tuple(r) for r in decontaminate.decontaminate(docs, bench).collect())
    made, real = f"{tmp_path}/made", decontaminate.windows_of

    def recorded(block, width=10):
        with open(made, "a") as out:
            out.write(f"{os.getpid()} {len(block)}\n")
        return real(block, width)

    monkeypatch.setattr(decontaminate, "windows_of", recorded)
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 200)
    assert Counter(tuple(r) for r in decontaminate.decontaminate(docs, bench).collect()) == want
    lines = [line.split() for line in open(made)]
    assert len(lines) > 3 and sum(int(n) for _, n in lines) == 22
    assert all(int(pid) != os.getpid() for pid, _ in lines)

"""Shards of a vocabulary whose ids do not fit 16 bits."""

from __future__ import annotations

import base64

import numpy as np
import public_tokenizers as P


def test_wide_ids_keep_their_width(spark, tmp_path):
    from tallyloom.llm.training_slots import id_width, read_slots, training_shards, write_shards

    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 300, b"abc": 70000}
    path = tmp_path / "wide.tiktoken"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(n).encode() for t, n in ranks.items()))
    assert id_width(str(path)) == 4 and id_width(P.path("byte_bpe_50k.tiktoken")) == 2

    docs = spark.createDataFrame([(i, "abc" * (i + 1) + "ab") for i in range(30)] + [(99, None), (100, "")], "doc_id long, text string")
    shards = training_shards(docs, str(path), P.PATTERN, 7, length=8, slots=4)
    rows = shards.collect()
    assert all(r.width == 4 and r.stride == 32 and len(r.payload) == r.n_slots * r.stride for r in rows)
    write_shards(shards, out := str(tmp_path / "shards"))
    found: dict[int, dict[int, list[int]]] = {}
    total = sum(r.n_slots for r in rows)
    slots = read_slots(spark, out, 0, total).collect()
    for r in slots:
        found.setdefault(r.doc_id, {})[r.piece] = np.frombuffer(r.ids, "<u4").tolist()
    assert [r.slot for r in slots] == list(range(total))
    joined = {d: [x for i in sorted(p) for x in p[i]] for d, p in found.items()}
    assert joined == {i: [70000] * (i + 1) + [300] for i in range(30)}

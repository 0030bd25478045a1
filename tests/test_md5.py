"""Vectorised MD5 minima against hashlib, and the md5 signature made without rows per shingle."""

import hashlib
import random

import numpy as np

from trawl.functions import md5
from trawl.operators import minhash as MH


def first_word(message: bytes) -> int:
    return int.from_bytes(hashlib.md5(message).digest()[:4], "little")


def test_minima_of_messages_of_all_block_counts():
    rng = random.Random(2)
    messages = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(1, 140, 3), 1014, 1015, 1016, 3000]]
    size = np.array([len(m) for m in messages])
    owner = np.sort(np.array([rng.randrange(9) for _ in messages]))
    got = md5.minima(np.frombuffer(b"".join(messages), np.uint8), np.cumsum(size) - size, size, owner, 10, 102)
    for k in range(10):
        mine = [m for m, o in zip(messages, owner, strict=True) if o == k]
        assert got[k].tolist() == [min((first_word(f"{i}-".encode() + m) for m in mine), default=0) for i in range(102)]


def test_signatures_of_documents_without_a_row_per_shingle(spark):
    rng = random.Random(5)
    texts = ["", "one", "a b c", "Straße über größe " * 9, "x" * 2000 + " tail", *[
        " ".join(f"w{rng.randrange(50)}" for _ in range(n)) for n in (4, 5, 6, 700)]]
    p = MH.MinHashParams(num_hashes=20, num_bands=4)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])] + [(2, texts[2])], "doc_id long, text string")
    rows = MH.signature_table(docs, p)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("translate(") == 1
    got = {r.doc_id: r.sig for r in rows.collect()}
    assert rows.count() == len(texts) + 1  # the repeated row is one
    for r in MH.shingle_table(docs, p).distinct().collect():
        assert got[r.doc_id] == [min((first_word(f"{i}-{s}".encode()) for s in r.sh), default=0) for i in range(20)]


def test_few_hashes_take_tiles_of_as_many_values(monkeypatch):
    sizes, made = [], md5._tile
    monkeypatch.setattr(md5, "_tile", lambda *a: sizes.append((v := made(*a)).size) or v)
    data = np.random.default_rng(3).integers(0, 256, 40_000, dtype=np.uint8)
    n = 9_000
    start, owner = np.arange(n), np.arange(n) // 100
    for hashes in (8, 100):
        sizes.clear()
        got = md5.minima(data, start, np.full(n, 30), owner, 90, hashes)
        assert len(sizes) <= 1.5 * n * hashes / md5.VALUES + 3 and max(sizes) <= md5.VALUES
        for i in (0, hashes - 1):
            assert got[89, i] == min(first_word(f"{i}-".encode() + data[j:j + 30].tobytes()) for j in range(8_900, n))

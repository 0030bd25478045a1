"""The md5 signature as a Java UDF: against hashlib and against its numpy form."""

import hashlib
import random

import pytest

from trawl.functions import text as TX
from trawl.operators import minhash as MH

LETTERS = "abcdefghijklmnopqrstuvwxyzß€語"


def first_word(message: bytes) -> int:
    return int.from_bytes(hashlib.md5(message).digest()[:4], "little")


def signature(text: str, n: int, hashes: int) -> list[int]:
    words = text.split(" ") if text else []
    grams = {" ".join(words[j:j + n]) for j in range(max(1, len(words) - n + 1))} if words else set()
    return [min((first_word(f"{i}-{g}".encode()) for g in grams), default=0) for i in range(hashes)]


def normalised(spark, rows: list[str | None]) -> list[str]:
    df = spark.createDataFrame(list(enumerate(rows)), "i int, t string").select("i", TX.normalize_text("t").alias("n"))
    return [r.n for r in df.orderBy("i").collect()]


def texts() -> list[str | None]:
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice(LETTERS) for _ in range(n))
    made = ["", "a", "a b", "a b c d", "a b c d e", "a a a a a a a a", None]
    made += [word(n) for n in [*range(40, 62), 117, 118, 119, 120, 1012, 1013, 1014, 1015, 1016, 3000]]  # all paddings, no blank
    made += [" ".join(word(rng.choice([1, 3, 8, 30, 90])) for _ in range(n)) for n in (6, 40, 700)]  # blocks mixed in a text
    return made + [" ".join(word(rng.randrange(1, 9)) for _ in range(n)) for n in (7, 511, 512, 516, 517, 1100)]


@pytest.mark.parametrize("n, hashes", [(5, 1), (5, 10), (5, 102), (1, 20), (3, 1003)])
def test_signatures_as_hashlib_makes_them(spark, n, hashes):
    p = MH.MinHashParams(num_hashes=hashes, num_bands=1, ngrams=n)
    rows = [t for t in texts() if hashes < 1000 or len(t or "") < 400]
    docs = spark.createDataFrame(list(enumerate(rows)), "i int, t string").repartition(3)
    got = {r.i: r.s for r in docs.select("i", MH.md5_sets(spark, "t", p)["sig"].alias("s")).collect()}
    for i, t in enumerate(normalised(spark, rows)):
        assert got[i] == signature(t, n, hashes), (i, t)


def test_numpy_form_and_other_sessions_agree(spark, monkeypatch):
    p = MH.MinHashParams(num_hashes=110, num_bands=10, ngrams=4)
    rng = random.Random(4)
    pool = [*map(chr, range(1, 0x180)), *"\u0301\u0130\u03a3\u03c2\u2003\u2028\ufb01\ud55c\u0958\u00bd\u2167\u0660\U0001d400\U0001f600\u01c5\u02b0 "]
    wild = ["".join(rng.choice(pool) for _ in range(n)) for n in (1, 2, 30, 400, 3000)] + ["\x1c a\x1d\x1fb -\x85 c\x7f \x0b", " - ", *pool]
    more = [*wild, "b a " * 40, "ab a b", "a\u00ff \u20ac \U00020000 a " * 5, "same word " * 9 + "same", "x" * 9 + " " + "x" * 8 + " " + "x" * 10]
    rows = list(enumerate([*texts(), *more, *more]))
    for session in (spark, spark.newSession()):
        docs = session.createDataFrame(rows, "doc_id int, text string").repartition(2)
        java = {r.doc_id: (r.set_key, r.n_sh, r.sig) for r in MH.signature_table(docs, p).collect()}
        with monkeypatch.context() as m:
            m.setattr(MH, "java_function", lambda *a: None)
            assert java == {r.doc_id: (r.set_key, r.n_sh, r.sig) for r in MH.signature_table(docs, p).collect()}
        assert len(java) == len(rows)


def test_no_text_goes_to_python(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, None)], "doc_id long, text string")
    plan = MH.signature_table(docs, MH.MinHashParams())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("trawl_md5minima(") == 1 and "regexp_extract_all" not in plan  # shingles are no strings


def test_numpy_form_stands_in_without_a_compiler(spark, monkeypatch):
    monkeypatch.setattr(MH, "java_function", lambda *a: None)
    docs = spark.createDataFrame([(1, "Größe a b c d e f"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.sig for r in MH.signature_table(docs, MH.MinHashParams(num_hashes=20, num_bands=4)).collect()}
    assert got == {1: signature("große a b c d e f", 5, 20), 2: [0] * 20}

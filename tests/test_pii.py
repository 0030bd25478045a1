"""PII masking: addresses and numbers in own sentences, chain order, idempotence.

Fixed values: the three mask tokens and the four accepted phone shapes.
"""

import pytest
from pyspark.sql import functions as F

from trawl.functions import pii as P
from trawl.operators.pii import mask_pii

EMAIL, PHONE, IP = "|||EMAIL_ADDRESS|||", "|||PHONE_NUMBER|||", "|||IP_ADDRESS|||"
PHONE_SHAPES = ["{a}{b}{c}", "({a})-{b}-{c}", "({a}) {b} {c}", "{a}-{b}-{c}"]


def masked(spark, fn, text):
    t, n = fn(F.col("text"))
    r = spark.createDataFrame([(text,)], "text string").select(t.alias("t"), n.alias("n")).first()
    return r.t, r.n


@pytest.mark.parametrize("addresses", [["kim.o+news@mail.example.org"], ["a_1@x.io", "b%2@y-z.museum", "C.D@E.FR"]])
def test_every_email_is_masked(spark, addresses):
    text = "; ".join(f"reader {i} wrote from {a}" for i, a in enumerate(addresses))
    want = "; ".join(f"reader {i} wrote from {EMAIL}" for i, _ in enumerate(addresses))
    assert masked(spark, P.mask_emails, text) == (want, len(addresses))


@pytest.mark.parametrize("text", ["no at sign here.example.org", "lonely@host", "@nobody.example", "x@y.z"])
def test_what_is_no_email_stays(spark, text):
    assert masked(spark, P.mask_emails, text) == (text, 0)


def test_a_mask_in_the_input_is_not_counted(spark):
    assert masked(spark, P.mask_emails, f"{EMAIL} and q@r.net") == (f"{EMAIL} and {EMAIL}", 1)


@pytest.mark.parametrize("shape", PHONE_SHAPES)
def test_phone_shapes(spark, shape):
    number = shape.format(a="415", b="555", c="0198")
    assert masked(spark, P.mask_phone_numbers, f"Ring {number} after six.") == (f"Ring {PHONE} after six.", 1)


@pytest.mark.parametrize("text", ["order 41555501981", "94155550198", "41-555-0198"])
def test_phone_needs_ten_digits_of_its_own(spark, text):
    assert masked(spark, P.mask_phone_numbers, text) == (text, 0)


@pytest.mark.parametrize("address,n", [("10.20.30.40", 1), ("255.255.255.255", 1), ("256.1.1.1", 0), ("1.2.3", 0)])
def test_addresses(spark, address, n):
    assert masked(spark, P.mask_ips, f"host {address};") == (f"host {IP if n else address};", n)


def test_chain_and_idempotence(spark):
    df = spark.createDataFrame([(1, "to z@q.org or 415-555-0198 via 172.16.0.9")], "doc_id long, text string")
    r = mask_pii(df).first()
    assert r.masked == f"to {EMAIL} or {PHONE} via {IP}"
    assert (r.n_email, r.n_phone, r.n_ip) == (1, 1, 1)
    again = mask_pii(df.select("doc_id", F.lit(r.masked).alias("text"))).first()
    assert again.masked == r.masked and (again.n_email, again.n_phone, again.n_ip) == (0, 0, 0)

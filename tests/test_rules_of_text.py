"""Predicates, identifiers, routes and sizes on hand-written cases."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark import fixed_values as fv
from tidemark.functions import checks, identity, text
from tidemark.functions.keccak import checksum_batch, keccak_256


def evaluate(spark, values, make, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


def test_valid_identifier(spark):
    cases = ["abc", "a-b_c/d,e.f g:h", "", None, "a$b", "a\n", "é", "did:erc721:1:0xA:2"]
    assert evaluate(spark, cases, checks.valid_identifier) == [True, True, False, False, False, False, False, True]


def test_address_forms(spark):
    good = "0x" + "ab" * 20
    cases = [good, good[2:], good.upper().replace("0X", "0x"), "0x123", "not-an-address", None, good + "\n"]
    assert evaluate(spark, cases, checks.address_ok) == [True, True, True, False, False, False, False]


# The outcomes that state the rule.
@pytest.mark.parametrize(
    "vin,ok",
    [
        ("1HGCM82633A123456", True),
        ("1HGCM123", False),
        ("1HGCM82633A12345I", False),
        ("1HGCM82633A12345Q", False),
        ("AAAAAAAAAAAAAAAAQ", False),
        ("SNT33-042261", True),
        ("INVALID-VIN-HERE!", False),
    ],
)
def test_vin(spark, vin, ok):
    assert evaluate(spark, [vin], checks.vin_ok) == [ok]


def test_lat_lon(spark):
    """Each bound, one step to either side of it, and what is no number, by rule."""
    step = 1e-6
    cases = []
    for axis, bound in ((0, 90.0), (1, 180.0)):
        for sign in (1, -1):
            for moved, ok in ((0.0, True), (-step, True), (step, False)):
                pair = [12.5, 12.5]
                pair[axis] = sign * (bound + moved)
                cases.append((*pair, ok))
        for odd in (math.nan, math.inf, -math.inf, None):
            pair = [12.5, 12.5]
            pair[axis] = odd
            cases.append((*pair, False))
    # Only both at zero together mean "no position".
    cases += [(-0.0, 0.0, False), (0.0, step, True), (step, 0.0, True)]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, lat double, lon double, want boolean")
    got = rows.select("want", checks.valid_lat_lon(F.col("lat"), F.col("lon")).alias("got"))
    assert got.where("want <> got").count() == 0


def test_parse_size(spark):
    """Every unit in every spelling, with a whole and a broken number; the rest is 0."""
    cases = {}
    for power, unit in enumerate(("b", "k", "m", "g", "t")):
        spellings = ("b",) if unit == "b" else (f"{unit}b", f"{unit}ib")
        for spelling in spellings:
            for written in (spelling, spelling.upper()):
                cases[f"6{written}"] = 6 * 1024**power
                cases[f"\t2.25 {written}  "] = int(2.25 * 1024**power)
    cases |= {"4096": 4096, ".5kb": 512, "+6kb": 0, "6 k b": 0, "6k": 0, "kb": 0, "6%": 0, "six": 0, "6pb": 0, "": 0}
    assert evaluate(spark, list(cases), text.parse_size) == list(cases.values())


def test_keccak_known_digest():
    import numpy as np

    empty = keccak_256(np.zeros((1, 0), dtype=np.uint8))[0].tobytes().hex()
    assert empty == "c5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"


def test_checksum_published_vectors():
    # Addresses published with the checksum standard.
    vectors = [
        "0x5aAeb6053F3E94C9b9A09f33669435E7Ef1BeAed",
        "0xfB6916095ca1df60bB79Ce92cE3Ea74c37c5d359",
        "0xdbF03B407c01E7cD3CBea99509d93f8DDDC8C6FB",
        "0xD1220A0cf47c7B9Be7A2E6BA89F429762e7b9aDb",
    ]
    assert checksum_batch([v.lower() for v in vectors]) == vectors
    assert checksum_batch([v[2:].upper() for v in vectors]) == vectors


def test_canonical_did(spark):
    summed = "0xbA5738a18d83D41847dfFbDC6101d37C69c9B0cF"
    low = summed.lower()
    cases = {
        f"did:erc721:1:{low}:2": f"did:erc721:1:{summed}:2",
        f"did:erc721:01:{low}:007": f"did:erc721:1:{summed}:7",
        f"did:erc721:1:{summed}:2": f"did:erc721:1:{summed}:2",
        f"did:nft:1:{low}_2": f"did:erc721:1:{summed}:2",
        f"did:erc721:1:{low[2:]}:0": f"did:erc721:1:{summed}:0",
        "../../../tenantB/x": None,
        "not-a-did": None,
        f"did:ethr:1:{low}": None,
        f"did:erc721:1:{low}:2\n": None,
        None: None,
    }
    assert evaluate(spark, list(cases), identity.canonical_did) == list(cases.values())
    with_account = lambda c: identity.canonical_did(c, legacy=False, ethr=True)
    assert evaluate(spark, [f"did:ethr:1:{low}", f"did:nft:1:{low}_2"], with_account) == [f"did:ethr:1:{summed}", None]


def test_vehicle_subject(spark):
    low = "0xba5738a18d83d41847dffbdc6101d37c69c9b0cf"
    cases = [f"did:erc721:137:{low}:1", f"did:erc721:1:{low}:1", "did:erc721:137:0x" + "0" * 40 + ":1", f"did:nft:137:{low}_1", None]
    check = lambda c: identity.is_vehicle_subject(c, 137, low)
    assert evaluate(spark, cases, check) == [True, False, False, False, False]


def test_routes(spark):
    did = "did:erc721:137:0xbA5738a18d83D41847dfFbDC6101d37C69c9B0cF:42"
    rows = spark.createDataFrame(
        [(1, fv.TYPE_STATUS, did), (2, "a.raw.v1/extra", "sub ject*with>stars"), (3, fv.TYPE_STATUS, "")],
        "i int, t string, s string",
    ).orderBy("i")
    got = [r[0] for r in rows.select(identity.route_subject(F.col("t"), F.col("s"))).collect()]
    status = fv.TYPE_STATUS.replace(".", "_")
    assert got == [f"in.raw.{status}.{did}", "in.raw.a_raw_v1-extra.sub-ject-with-stars", f"in.raw.{status}.-"]


def test_route_partition_is_fnv1a(spark):
    def fnv(s):
        h = 2166136261
        for b in s.encode():
            h = ((h ^ b) * 16777619) % (1 << 32)
        return h

    subjects = ["", "a", "did:erc721:137:0xA:1", "ünïcode", "x" * 200]
    got = evaluate(spark, subjects, lambda c: identity.route_partition(c, 7))
    assert got == [fnv(s) % 7 for s in subjects]
    assert evaluate(spark, subjects, lambda c: identity.route_partition(c, 1)) == [0] * 5


def test_name_token(spark):
    assert evaluate(spark, ["a b.c*d>e\tf\ng\rh", "", None, "speed"], identity.name_token) == ["a_b_c_d_e_f_g_h", "_", "_", "speed"]


def test_message_id_depends_on_type(spark):
    rows = spark.sql(
        "SELECT 's' AS subject, TIMESTAMP '2026-06-01 00:00:00' AS time, type, 'src' AS source, 'x' AS id "
        "FROM VALUES ('a'), ('a'), ('b') AS t(type)"
    )
    ids = [r[0] for r in rows.select(identity.message_id()).collect()]
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 64


def test_content_types(spark):
    cases = [
        (None, False, None),
        ("image/png", False, "content_type_not_json"),
        ("image/png", True, None),
        (None, True, "missing_content_type"),
        ("text/plain", True, "content_type_not_allowed"),
        ("application/json", False, None),
    ]
    rows = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, ct string, b64 boolean, want string")
    ct = F.when(~F.col("b64") & F.col("ct").isNull(), F.lit("application/json")).otherwise(F.col("ct"))
    got = rows.orderBy("i").select(checks.content_type_fault(ct, F.col("b64"))).collect()
    assert [r[0] for r in got] == [c[2] for c in cases]


def test_attestation_types(spark):
    raw, document = fv.ATTESTATION_PREFIXES
    good = [fv.TYPE_ATTESTATION, fv.TYPE_TOMBSTONE, raw + "insurance", document + "vehicle.registration"]
    bad = ["", raw, document, fv.TYPE_SIGNALS, fv.TYPE_STATUS, "random", None]
    assert evaluate(spark, good + bad, checks.attestation_type_ok) == [True] * 4 + [False] * 7


def test_future_is_strict(spark):
    rows = spark.sql(
        "SELECT t, TIMESTAMP '2026-01-01 00:00:00' AS now FROM VALUES "
        "(TIMESTAMP '2026-01-01 00:05:00'), (TIMESTAMP '2026-01-01 00:05:00.000001') AS v(t)"
    )
    got = rows.orderBy("t").select(checks.is_future(F.col("t"), F.col("now"))).collect()
    assert [r[0] for r in got] == [False, True]

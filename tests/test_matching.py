"""Matching: the name-level plan must equal a brute-force pair table."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakegov.operators import matching as M


def lev(a: str, b: str) -> int:
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def norm(s, collapse):
    out = re.sub(r"[^A-Za-z0-9 ]", " ", s).strip().upper()
    return re.sub(r"\s+", " ", out) if collapse else out


def half_up(x: float) -> int:
    import decimal
    return int(decimal.Decimal(repr(x)).quantize(decimal.Decimal(1), rounding=decimal.ROUND_HALF_UP))


def brute(recs, auto_t, stew_t):
    """The reference semantics, pair by pair."""
    out = []
    for a in recs:
        for b in recs:
            if norm(a[1], False) != norm(b[1], False) or not a[0] < b[0]:
                continue
            n1, n2 = norm(a[2], True), norm(b[2], True)
            L = max(len(n1), len(n2))
            score = 0 if L == 0 else half_up((1 - lev(n1, n2) / L) * 100)
            if score < stew_t:
                continue
            act = "AUTO_MERGE" if score >= auto_t else "STEWARD_REVIEW"
            rec = a[0] if len(a[2]) > len(b[2]) else b[0] if len(b[2]) > len(a[2]) else min(a[0], b[0])
            out.append((a[0], b[0], a[1], a[2], b[2], score, act, rec))
    return sorted(out)


def spark_pairs(spark, recs, auto_t, stew_t):
    df = spark.createDataFrame(recs, "location_id int, borough string, zone string")
    m = M.match_records(df, "location_id", "zone", "borough", auto_t, stew_t, batch_id="b")
    p = M.expand_pairs(m, df, "location_id", "zone", "borough")
    return sorted((r.location_id_1, r.location_id_2, r.borough, r.zone_1, r.zone_2, r.score, r.action,
                   r.recommended_golden_id) for r in p.collect()), m


ZONES = [
    (1, "Manhattan", "Upper East Side North"), (2, "Manhattan", "Upper East Side South"),
    (3, "Manhattan", "Upper West Side North"), (4, "Queens", "Jamaica"), (5, "Queens", "Jamaica Bay"),
    (56, "Queens", "Corona"), (57, "Queens", "Corona"),            # exact duplicate names
    (103, "Manhattan", "Governor's Island/Ellis Island/Liberty Island"),
    (104, "Manhattan", "Governor's Island/Ellis Island/Liberty Island"),
    (105, "Manhattan", "Governor's Island/Ellis Island/Liberty Island"),
    (6, "Bronx", "!!!"), (7, "Bronx", "???"),                      # both empty after normalising
    (8, "Bronx", "Morris Park East"), (9, "Bronx", "Morris Park West"),  # equal length -> smaller id
    (10, "Brooklyn", "Corona"),                                    # other block: no pair with 56/57
    (11, "staten island", "Arden Heights"), (12, "Staten Island", "Arden  Heights"),  # block normalises
]


@pytest.mark.parametrize("auto_t,stew_t", [(89, 80), (100, 80), (90, 60), (75, 75), (101, 1)])
def test_zone_fixture_matches_brute_force(spark, auto_t, stew_t):
    got, _ = spark_pairs(spark, ZONES, auto_t, stew_t)
    assert got == brute(ZONES, auto_t, stew_t)


def test_fixture_cases(spark):
    got, m = spark_pairs(spark, ZONES, 89, 80)
    by_ids = {(g[0], g[1]): g for g in got}
    assert by_ids[(56, 57)][5] == 100 and by_ids[(56, 57)][6] == "AUTO_MERGE"
    assert (6, 7) not in by_ids                                    # empty names score 0
    assert by_ids[(8, 9)][7] == 8                                  # tie -> smaller id
    assert not any({g[0], g[1]} & {10} for g in got)               # different block
    assert (103, 104) in by_ids and (104, 105) in by_ids and (103, 105) in by_ids
    # name-level table carries the pair count instead of the pairs
    gov = [r for r in m.collect() if r.name_1.startswith("GOVERNOR")]
    assert gov[0].pair_count == 3


def test_score_exactly_at_thresholds(spark):
    # 'abcdefghij' vs 'abcdefghiX': lev 1 of 10 -> score 90
    recs = [(1, "b", "abcdefghij"), (2, "b", "abcdefghiX")]
    got, _ = spark_pairs(spark, recs, 90, 90)
    assert got[0][5] == 90 and got[0][6] == "AUTO_MERGE"
    got, _ = spark_pairs(spark, recs, 91, 90)
    assert got[0][6] == "STEWARD_REVIEW"
    got, _ = spark_pairs(spark, recs, 95, 91)
    assert got == []


names = st.text(alphabet="ab c-", min_size=0, max_size=9)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), names), min_size=2, max_size=14),
       st.integers(min_value=1, max_value=100))
def test_property_signature_join_is_lossless(spark, items, stew_t):
    recs = [(i + 1, b, n) for i, (b, n) in enumerate(items)]
    got, _ = spark_pairs(spark, recs, 101, stew_t)
    assert got == brute(recs, 101, stew_t)


def test_random_names_medium(spark):
    rnd = random.Random(7)
    words = ["north", "south", "east", "west", "park", "hill", "heights", "village", "yard"]
    recs = [(i, rnd.choice(["A", "B"]), " ".join(rnd.sample(words, rnd.randint(1, 3))) + rnd.choice(["", "s", " 2"]))
            for i in range(1, 160)]
    for auto_t, stew_t in ((95, 70), (100, 85)):
        got, _ = spark_pairs(spark, recs, auto_t, stew_t)
        assert got == brute(recs, auto_t, stew_t)


def test_pending_status_and_decisions(spark):
    df = spark.createDataFrame(ZONES, "location_id int, borough string, zone string")
    m = M.match_records(df, "location_id", "zone", "borough", 89, 80, batch_id="b1")
    want_pending = {i for p in brute(ZONES, 89, 80) if p[6] == "STEWARD_REVIEW" for i in p[:2]}
    got = {r[0] for r in M.pending_ids(m, df, "location_id", "zone", "borough").collect()}
    assert got == want_pending and got
    st_ = M.stage_records(df, m, "location_id", "zone", "borough", "b1", "zones.csv")
    status = {r.location_id: r.status for r in st_.collect()}
    assert {k for k, v in status.items() if v == "PENDING"} == want_pending
    assert status[56] == "APPROVED"                               # AUTO_MERGE changes nothing
    dec = spark.createDataFrame([("b1", min(want_pending), "REJECTED", None), ("b1", 56, "BAD", "x")],
                                "batch_id string, location_id int, decision string, zone string")
    out = {r.location_id: r for r in M.apply_decisions(st_, dec, "location_id", ("zone",)).collect()}
    assert out[min(want_pending)].status == "REJECTED"
    assert out[56].status == "APPROVED" and out[56].zone == "Corona"   # invalid decision ignored


@pytest.mark.parametrize("auto_t,stew_t,heavy", [(100, 95, 14), (95, 70, 12)])
def test_heavy_signatures_lose_no_pair(spark, auto_t, stew_t, heavy):
    """Signatures shared by more than ``heavy`` names are cut further and joined in cells."""
    rnd = random.Random(11)
    words = ["north", "south", "park", "hill", "yard"]
    recs = [(i, "A", f"building number {rnd.choice(words)} {rnd.randint(0, 40)}") for i in range(1, 90)] + [(200, "B", "alone")]
    df = spark.createDataFrame(recs, "location_id int, borough string, zone string")
    m = M.match_records(df, "location_id", "zone", "borough", auto_t, stew_t, batch_id="b", heavy=heavy)
    got = sorted((r.location_id_1, r.location_id_2, r.borough, r.zone_1, r.zone_2, r.score, r.action, r.recommended_golden_id)
                 for r in M.expand_pairs(m, df, "location_id", "zone", "borough").collect())
    assert got == brute(recs, auto_t, stew_t)


def test_heavy_family_is_cut_to_small_groups(spark):
    """600 names that differ in digits alone: the signatures that are joined hold few names."""
    df = spark.range(600).selectExpr("cast(id AS int) AS location_id", "'b' AS borough", "format_string('BUILDING NUMBER %05d', id) AS zone")
    groups = M.name_groups(M.normalize_members(df, "location_id", "zone", "borough")).checkpoint()
    hits = M.name_hits(groups, 95, heavy=120)
    pairs = {(min(r.r, r.s), max(r.r, r.s)) for r in hits.collect()}
    # one edit: the same name but for one digit
    names = [f"BUILDING NUMBER {i:05d}" for i in range(600)]
    want = {(a, b) for i, a in enumerate(names) for b in names[i + 1:] if sum(x != y for x, y in zip(a, b)) == 1}
    assert want <= pairs
    assert all(lev(a, b) <= 1 for a, b in list(pairs)[:200])


@pytest.mark.parametrize("auto_t,stew_t", [(89, 80), (100, 60), (101, 70)])
def test_review_queue_gives_the_best_partner(spark, auto_t, stew_t):
    rnd = random.Random(3)
    words = ["north", "south", "east", "west", "park", "hill"]
    recs = ZONES + [(i, "Z", " ".join(rnd.sample(words, 2)) + rnd.choice(["", "s", " 2"])) for i in range(300, 340)]
    df = spark.createDataFrame(recs, "location_id int, borough string, zone string")
    got = {r.location_id: (r.best_partner_id, r.score) for r in
           M.review_queue(df, "location_id", "zone", "borough", auto_t, stew_t, "b").collect()}
    raw = {i: z for i, _, z in recs}
    best = {}
    for a, b, _, _, _, score, act, _ in brute(recs, auto_t, stew_t):
        if act == "STEWARD_REVIEW":
            for me, other in ((a, b), (b, a)):
                best.setdefault(me, []).append((score, other))
    assert set(got) == set(best)
    names = {i: (norm(b, False), norm(z, True)) for i, b, z in recs}
    for me, options in best.items():
        top = max(s for s, _ in options)
        assert got[me][1] == top
        assert got[me][0] in {o for s, o in options if s == top}
        same = [o for s, o in options if s == top and names[o] == names[got[me][0]] and o != me]
        assert got[me][0] == min(same, key=lambda o: (-len(raw[o]), o))

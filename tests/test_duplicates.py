import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import banding, cards, matching
from ledgerloom.operators import evaluation as E
from ledgerloom.operators import similarity_join as SJ
from ledgerloom.operators.components import min_labels
from ledgerloom.operators.ordered import cumulative, folded_by_value, percentiles
from ledgerloom.functions.hashing import hash_grams
from ledgerloom.functions.similarity import jaccard
from ledgerloom.operators.signatures import hashed, raw_shingles, signed, with_signatures
from ledgerloom.plans import notice_inputs as N
from ledgerloom.session import materialise
from ledgerloom.sources import lake
from ledgerloom.streaming import arrivals

NOTICE = "notice_id bigint, portal_id string, title string, body string"


def corpus(seed=7, themes=6, per_theme=9):
    """Notices in themes of near copies of growing distance, with exact copies and empty fields."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, next_id = [], 1
    for theme in range(themes):
        title = [rng.choice(words) for _ in range(6)]
        body = [rng.choice(words) for _ in range(40)]
        for copy in range(per_theme):
            changed = list(body)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 7, 10])):
                changed[rng.randrange(40)] = rng.choice(words)
            portal = f"p{rng.randrange(3)}" if theme % 3 else "p0"
            rows.append((next_id, portal, " ".join(title[: rng.choice([5, 6])]), " ".join(changed)))
            next_id += 1
    rows += [(next_id + i, f"p{i % 2}", "", "") for i in range(6)]
    rows += [(next_id + 6 + i, f"p{i % 2}", "same title here", "") for i in range(4)]
    return rows


def as_dict(sets):
    return {r["notice_id"]: r for r in sets.collect()}


def similarity(a, b):
    def j(x, y):
        x, y = set(x), set(y)
        return len(x & y) / len(x | y) if x and y else 0.0

    return 0.5 * j(a["title_set"], b["title_set"]) + 0.5 * j(a["body_set"], b["body_set"])


def band_pairs(rows, across=True, cap=None):
    buckets = {}
    for i, row in rows.items():
        for band in range(32):
            buckets.setdefault((band, tuple(row["signature"][4 * band: 4 * band + 4])), []).append(i)
    out = {}
    for members in buckets.values():
        if len(members) < 2 or (cap and len(members) > cap):
            continue
        for a in members:
            for b in members:
                if a < b and not (across and rows[a]["portal_id"] == rows[b]["portal_id"]):
                    out[a, b] = min(out.get((a, b), 10**9), len(members))
    return out


def clusters(ids, edges):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def true_edges(rows, across=True):
    found = []
    for a, b in band_pairs(rows, across):
        agree = np.mean(np.array(rows[a]["signature"]) == np.array(rows[b]["signature"]))
        if agree >= matching.SCREEN and similarity(rows[a], rows[b]) >= matching.TAU:
            found.append((a, b))
    return found


@pytest.fixture(scope="module")
def sets(spark):
    return signed(spark.createDataFrame(corpus(), NOTICE))


@pytest.fixture(scope="module")
def rows(sets):
    return as_dict(sets)


def test_candidates_with_and_without_cap(sets, rows):
    for cap in (3, 150):
        found = {(r["id_a"], r["id_b"]) for r in banding.capped_candidates(sets, cap).collect()}
        assert found == set(band_pairs(rows, cap=cap))


@pytest.mark.parametrize("across", [True, False])
def test_smallest_shared_bucket_of_every_pair(spark, sets, rows, across):
    every = [(a, b) for a in rows for b in rows if a < b]
    found = banding.smallest_shared(spark.createDataFrame(every, "id_a bigint, id_b bigint"), sets, "portal_id" if across else None).collect()
    assert {(r["id_a"], r["id_b"]): r["min_bucket"] for r in found if r["min_bucket"]} == band_pairs(rows, across=across)


def test_bucket_of_exactly_the_cap_is_kept(spark):
    copies = [(i, f"p{i}", "one title here", "the very same body of words") for i in range(5)]
    sets = signed(spark.createDataFrame(copies, NOTICE))
    assert banding.capped_candidates(sets, 5).count() == 10 and banding.capped_candidates(sets, 4).count() == 0


def test_verified_pairs(sets, rows):
    pairs = matching.screen(banding.capped_candidates(sets, 150), sets).select("id_a", "id_b")
    found = {(r["id_a"], r["id_b"]) for r in matching.verify(pairs, sets).collect()}
    assert found == set(true_edges(rows))


@pytest.mark.parametrize(("cap", "across"), [(150, True), (2, True), (2, False)])
def test_clusters_equal_brute_force(sets, rows, cap, across):
    """A cap of 2 sends almost every bucket through the star and rare-shingle routes."""
    expected = clusters(rows, true_edges(rows, across))
    found = {r["notice_id"]: r["root_id"] for r in cards.card_map(sets, cap=cap, across=across).collect()}
    assert found == expected
    assert len(set(found.values())) < len(found)


def test_one_wording_from_one_portal_stays_apart(spark):
    rows = [(i, "p0", "one title here", "the very same body of words") for i in range(4)]
    apart = signed(spark.createDataFrame(rows, NOTICE))
    assert {r["root_id"] for r in cards.card_map(apart).collect()} == {0, 1, 2, 3}
    joined = signed(spark.createDataFrame([*rows, (9, "p1", *rows[0][2:])], NOTICE))
    assert {r["root_id"] for r in cards.card_map(joined).collect()} == {0}


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    edges = [*chain, (100, 90), (90, 95), (200, 200)]
    random.Random(1).shuffle(edges)
    labels = {r["notice_id"]: r["label"] for r in min_labels(spark.createDataFrame(edges, "id_a bigint, id_b bigint")).collect()}
    assert labels == {**{i: 1 for i in range(1, 41)}, 90: 90, 95: 90, 100: 90}
    text = spark.createDataFrame([("n10", "n9"), ("n9", "n8")], "id_a string, id_b string")
    assert {r["label"] for r in min_labels(text).collect()} == {"n10"}
    assert min_labels(text.where("false")).count() == 0


def test_members_and_portals_are_rows(spark):
    mapping = spark.createDataFrame([(i, f"p{i % 7}", 0) for i in range(50)], "notice_id bigint, portal_id string, root_id bigint")
    assert sorted(r["notice_id"] for r in cards.card_members(mapping).collect()) == list(range(50))
    assert {r["portal_id"]: r["members"] for r in cards.card_portals(mapping).collect()} == {f"p{k}": 8 if k == 0 else 7 for k in range(7)}


def test_bucket_of_over_a_thousand_notices(spark):
    """Work, recall, probes and clusters of one wording on three portals; nothing is left out and no pair listed."""
    copies = [(i, f"p{i % 3}", "one title here", "the very same body of words") for i in range(1001)]
    sets = signed(spark.createDataFrame(copies, NOTICE))
    per_portal = {f"p{k}": sum(i % 3 == k for i in range(1001)) for k in range(3)}
    work = E.work_per_notice(sets, "portal_id", (0, 1000)).collect()
    assert all(r["work"] == (32 * (1001 - per_portal[r["portal_id"]]) if r["cap"] == 0 else 0) for r in work)
    labelled = spark.createDataFrame([(0, 1, True), (0, 3, True)], "id_a bigint, id_b bigint, is_same boolean")
    assert E.candidate_recall(labelled, sets).first()["found"] == 1 and E.candidate_recall(labelled, sets, None).first()["found"] == 2
    left = banding.skipped(sets, (0, 1000), None).collect()
    assert {r["cap"]: (r["skipped_buckets"], r["skipped_comparisons"]) for r in left} == {0: (0, 0), 1000: (32, 32 * 1001 * 500)}
    members = banding.memberships(sets)
    asked = sets.where("notice_id in (3, 500)").select(F.col("notice_id").alias("probe_id"))
    assert {tuple(r) for r in banding.expand_probes(banding.class_index(sets), members, asked).collect()} == {(3, 0), (500, 0)}
    assert {tuple(r) for r in members.collect()} == {(0, i) for i in range(1001)}
    assert {r["root_id"] for r in cards.card_map(sets).collect()} == {0}


def class_pairs(rows, pairs):
    """Pairs of notices as pairs of their wordings' smallest notices."""
    first = {}
    for i in sorted(rows):
        first.setdefault(rows[i]["text_key"], i)
    of = {i: first[rows[i]["text_key"]] for i in rows}
    return {(min(of[a], of[b]), max(of[a], of[b])) for a, b in pairs if of[a] != of[b]}


@pytest.mark.parametrize(("cap", "across"), [(150, True), (2, True), (2, False)])
def test_links_and_screened_of_buckets_of_any_size(sets, rows, cap, across):
    want = class_pairs(rows, true_edges(rows, across))
    found = matching.links(sets, cap=cap, across=across).collect()
    assert {(r["id_a"], r["id_b"]) for r in found} == want and len(found) == len(want) > 20
    assert all(abs(r["similarity"] - similarity(rows[r["id_a"]], rows[r["id_b"]])) < 1e-12 for r in found)
    agree = lambda a, b: np.mean(np.array(rows[a]["signature"]) == np.array(rows[b]["signature"]))
    passed = class_pairs(rows, [p for p in band_pairs(rows, across) if agree(*p) >= matching.SCREEN])
    assert {(r["id_a"], r["id_b"]) for r in matching.screened(sets, cap=cap, across=across).collect()} == passed


@pytest.mark.parametrize("across", ["portal_id", None])
def test_partner_sketches_count_each_partner_once(sets, rows, across):
    pairs = band_pairs(rows, across=bool(across))
    exact = {i: sum(i in p for p in pairs) for i in rows}
    found = {r["notice_id"]: r["partners_estimate"] for r in E.partner_estimates(sets, across).collect()}
    assert found.keys() == exact.keys() and all(abs(found[i] - exact[i]) <= 1 for i in rows) and max(exact.values()) >= 7
    if across:
        asked = sets.where("notice_id % 5 = 0").select(F.col("notice_id").alias("probe_id"))
        assert {r["probe_id"]: r["partners"] for r in E.partner_degrees(sets, asked).collect()} == {i: exact[i] for i in rows if i % 5 == 0}


def test_probes_meet_every_wording_of_their_buckets(sets, rows):
    probes = sets.where("notice_id % 4 = 0").select(F.col("notice_id").alias("probe_id"))
    found = banding.expand_probes(banding.class_index(sets), banding.memberships(sets), probes).collect()
    first = {}
    for i in sorted(rows):
        first.setdefault(rows[i]["text_key"], i)
    want = {(p, first[rows[o]["text_key"]]) for a, b in band_pairs(rows, across=False) for p, o in ((a, b), (b, a)) if p % 4 == 0}
    assert {tuple(r) for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize(("tau", "alpha", "hot"), [(0.6028, 0.5, 256), (0.6028, 0.5, 3), (0.8, 0.3, 2), (0.5, 0.9, 2)])
def test_similarity_join_loses_no_pair(spark, tau, alpha, hot):
    rng = random.Random(3)
    base = [([rng.randrange(30) for _ in range(5)], [rng.randrange(200) for _ in range(30)]) for _ in range(6)]
    sets = []
    for i in range(160):
        title, body = (list(x) for x in rng.choice(base))
        for own, size, n in ((title, 30, 2), (body, 200, 12)):
            for _ in range(rng.randint(0, n)):
                own[rng.randrange(len(own))] = rng.randrange(size)
        sets.append((i, sorted(set(title))[: rng.choice([0, 3, 5])], sorted(set(body))[: rng.choice([0, 10, 30, 30])], i % 5))
    frame = spark.createDataFrame(sets, "notice_id bigint, title_set array<bigint>, body_set array<bigint>, label bigint")

    def sim(a, b):
        j = lambda x, y: len(set(x) & set(y)) / len(set(x) | set(y)) if x and y else 0.0
        return alpha * j(a[1], b[1]) + (1 - alpha) * j(a[2], b[2])

    want = {(a[0], b[0]) for a in sets for b in sets if a[0] < b[0] and sim(a, b) >= tau}
    got = {(r["id_a"], r["id_b"]) for r in SJ.similar(frame.drop("label"), tau, alpha, hot, tile=4).collect()}
    assert want <= got and len(want) > 10 and all(a < b for a, b in got)
    got = {(r["id_a"], r["id_b"]) for r in SJ.similar(frame, tau, alpha, hot, tile=4).collect()}
    assert {(a, b) for a, b in want if a % 5 != b % 5} <= got and all(a % 5 != b % 5 for a, b in got)


def test_agreeing_signatures_lose_no_pair(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 9, size=(4, 16))
    rows = [(i, np.where(rng.random(16) < 0.5, base[i % 4], rng.integers(0, 9, 16)).tolist()) for i in range(120)]
    got = {(r["id_a"], r["id_b"]) for r in SJ.agreeing(spark.createDataFrame(rows, "notice_id bigint, signature array<bigint>"), 16, 0.45, tile=8).collect()}
    want = {(a, b) for a, x in rows for b, y in rows if a < b and np.mean(np.array(x) == np.array(y)) >= 0.45}
    assert want <= got and len(want) > 100


def template(n, words=40):
    """Different wordings of one template, and a smallest notice with its title and a sixth of its body."""
    rng = random.Random(9)
    title, body = "supply of the very same goods", [f"w{k}" for k in range(words)]
    rows = [(0, "p0", title, " ".join(body[: words // 3] + [f"x{k}" for k in range(words)]))]
    for i in range(1, n + 1):
        own = list(body)
        own[rng.randrange(words // 2, words)] = f"u{i}"
        rows.append((i, f"p{i % 3}", title, " ".join(own)))
    return rows


def test_a_template_group_whose_head_is_far_away_lists_few_pairs(spark, monkeypatch):
    sets = signed(spark.createDataFrame(template(5000), NOTICE))
    listed = []
    inner = matching.confirmed

    def counting(pairs, *rest):
        listed.append(pairs.count())
        return inner(pairs, *rest)

    monkeypatch.setattr(matching, "confirmed", counting)
    mapping = {r["notice_id"]: r["root_id"] for r in cards.card_map(sets).collect()}
    assert mapping == {0: 0, **{i: 1 for i in range(1, 5001)}}
    assert 5000 <= sum(listed) < 60_000 * 5


def test_a_bucket_under_the_cap_is_not_paired_in_full_for_clusters(spark, monkeypatch):
    sets = signed(spark.createDataFrame(template(140), NOTICE))
    listed = []
    inner = matching.confirmed

    def counting(pairs, *rest):
        listed.append(pairs.count())
        return inner(pairs, *rest)

    monkeypatch.setattr(matching, "confirmed", counting)
    mapping = {r["notice_id"]: r["root_id"] for r in cards.card_map(sets).collect()}
    assert mapping == {0: 0, **{i: 1 for i in range(1, 141)}}
    assert 140 <= sum(listed) < 140 * 139 // 4


def test_sets_are_shuffled_for_verification_alone(spark):
    sets = signed(spark.createDataFrame(template(30), NOTICE))
    plan = matching.screened(sets)._jdf.queryExecution().executedPlan().toString()
    assert "signature" in plan and "body_set" not in plan


def test_every_link_of_a_bucket_of_over_a_thousand_wordings(spark):
    sets = signed(spark.createDataFrame(template(1100, 20), NOTICE))
    rows = as_dict(sets)
    found = {(r["id_a"], r["id_b"]) for r in matching.links(sets).select("id_a", "id_b").collect()}
    band = band_pairs(rows)
    signatures = np.array([rows[i]["signature"] for i in range(1101)])
    grams = [frozenset(rows[i]["body_set"]) for i in range(1101)]
    want = set()
    for a, b in band:
        both = len(grams[a] & grams[b])
        if (signatures[a] == signatures[b]).mean() >= matching.SCREEN and 0.5 + 0.5 * both / (len(grams[a]) + len(grams[b]) - both) >= matching.TAU:
            want.add((a, b))
    assert found == want and len(want) > 200_000
    met = banding.expand_probes(banding.class_index(sets), banding.memberships(sets), spark.createDataFrame([(7,)], "probe_id bigint"))
    every = band_pairs(rows, across=False)
    assert {r["representative"] for r in met.collect()} == {b if a == 7 else a for a, b in every if 7 in (a, b)}
    degree = Counter(i for pair in band for i in pair)
    guess = E.partner_estimates(sets).collect()
    error = [(r["partners_estimate"] - degree[r["notice_id"]]) / max(1, degree[r["notice_id"]]) for r in guess]
    assert np.sqrt(np.mean(np.square(error))) < 0.04 and len(guess) == 1101


BODY = "build a long road from the north gate to the south gate over two bridges"


def arriving(spark, base, new):
    stored = signed(spark.createDataFrame(base, NOTICE))
    given = cards.card_map(stored).select("notice_id", cards.card_name(F.col("root_id")).alias("card_id"))
    fresh = signed(spark.createDataFrame(new, NOTICE))
    met = cards.touched(banding.buckets(stored), fresh.join(given, "notice_id", "left_anti"))
    mapped, aliases = cards.arrive(stored.join(met, "notice_id", "left_semi"), given, fresh)
    return ({r["notice_id"]: r["card_id"] for r in mapped.collect()},
            {r["card_id"]: r["same_as"] for r in aliases.collect()})


def test_arrivals_inherit_and_never_rename(spark):
    base = [(10, "p0", "road works north", BODY), (11, "p1", "road works north", BODY), (20, "p2", "school", "paint every wall of the old school")]
    new = [(5, "p3", "road works north", BODY + " soon"), (10, "p0", "changed", "already known"),
           (30, "p0", "bridge repair now", "mend the old bridge near the mill"), (31, "p1", "bridge repair now", "mend the old bridge near the mill")]
    mapped, aliases = arriving(spark, base, new)
    assert mapped == {5: "CARD-10", 30: "CARD-30", 31: "CARD-30"} and aliases == {}


def test_arrival_that_meets_two_cards_takes_the_smaller(spark):
    base = [(10, "p0", "road works north", BODY), (12, "p0", "road works north", BODY)]
    mapped, aliases = arriving(spark, base, [(15, "p1", "road works north", BODY)])
    assert mapped == {15: "CARD-10"} and aliases == {"CARD-12": "CARD-10"}


def written(monkeypatch, *modules):
    """Columns of everything that ``materialise`` writes for some modules from now on."""
    seen = []
    for module in modules:
        monkeypatch.setattr(module, "materialise", lambda df, label: seen.append((label, df.columns)) or materialise(df, label))
    return seen


def test_arrivals_and_their_sets_are_not_copied(spark, monkeypatch):
    seen = written(monkeypatch, cards, matching)
    base = [(10, "p0", "road works north", BODY), (20, "p2", "school", "paint every wall of the old school")]
    mapped, _ = arriving(spark, base, [(5, "p3", "road works north", BODY + " soon"), (20, "p0", "changed", "already known")])
    assert mapped == {5: "CARD-10"}
    assert len(seen) > 4 and not [label for label, columns in seen if {"signature", "title_set", "body_set"} & {*columns}]


def test_sides_of_pairs_are_rows_of_these_pairs_alone(spark, sets):
    pairs = spark.createDataFrame([(1, 2), (2, 5)], "id_a bigint, id_b bigint")
    assert {r["notice_id"] for r in matching._ends(pairs, sets).select("notice_id").collect()} == {1, 2, 5}


def test_stream_is_safe_to_repeat(spark, tmp_path):
    store = arrivals.CardStore(spark, str(tmp_path / "store"))
    first = spark.createDataFrame([(10, "p0", "road works north", BODY), (11, "p1", "road works north", BODY)], NOTICE)
    second = spark.createDataFrame([(5, "p2", "road works north", BODY), (11, "p9", "other", "text of a known id")], NOTICE)
    store.add(first, 0)
    store.add(second, 1)
    before = {r["notice_id"]: r["card_id"] for r in store.card_map().collect()}
    store.add(second, 1)
    assert before == {10: "CARD-10", 11: "CARD-10", 5: "CARD-10"}
    assert {r["notice_id"]: r["card_id"] for r in store.card_map().collect()} == before and store.card_map().count() == 3


def test_a_batch_copies_neither_its_texts_nor_its_sets(spark, tmp_path, monkeypatch):
    seen = written(monkeypatch, arrivals)
    store = arrivals.CardStore(spark, str(tmp_path / "store"), slots=2)
    rows = [(10, "p1", "b", "y"), (10, "p0", "z", "z"), (10, "p0", "a", None), (11, None, "t", BODY), (None, "p2", "n", "n"), (None, "p1", "m", "m")]
    store.add(spark.createDataFrame(rows, NOTICE), 0)
    kept = {(r["notice_id"], r["portal_id"]) for r in store.signed().collect()}
    assert kept == {(10, "p0"), (11, None), (None, "p1")} and store.signed().count() == 3 and store.index().count() == 96
    assert {r["notice_id"]: r["card_id"] for r in store.card_map().collect()} == {10: "CARD-10", 11: "CARD-11"}
    new, count = store._new(spark.createDataFrame([*rows, (12, "p0", "c", "c")], NOTICE), "batch-000000000001")
    assert {r["notice_id"] for r in new.collect()} == {None, 12} and count == 2
    copied = {label for label, columns in seen if {"title", "body", "title_set", "body_set"} & {*columns}}
    assert copied <= {"stored"}  # the stored notices that the batch meets


def test_a_batch_leaves_the_store_as_it_is_and_reads_what_it_meets(spark, tmp_path):
    store = arrivals.CardStore(spark, str(tmp_path / "store"))
    other = [(100 + i, f"p{i % 3}", f"title {i} alone", f"body {i} of other words number {i * 7}") for i in range(30)]
    store.add(spark.createDataFrame([(10, "p0", "road works north", BODY), (11, "p1", "road works north", BODY), *other], NOTICE), 0)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "store").rglob("*.parquet")}
    new = spark.createDataFrame([(5, "p2", "road works north", BODY)], NOTICE)
    met = {r["notice_id"] for r in cards.touched(store.index(), signed(new)).collect()}
    assert met == {10, 11}
    store.add(new, 1)
    assert all(f.stat().st_mtime_ns == t for f, t in files.items())
    assert store.card_map().where("notice_id = 5").first()["card_id"] == "CARD-10" and store.index().where("batch_id = 1").count() == 32
    store.add(new.where("false"), 1)
    assert store.card_map().where("batch_id = 1").count() == 0 and store.aliases().where("batch_id = 1").count() == 0


def test_fifty_batches_leave_few_files_and_a_batch_reads_few(spark, tmp_path):
    store = arrivals.CardStore(spark, str(tmp_path / "store"), slots=8, merge_after=12)
    other = [(100 + i, f"p{i % 3}", f"title {i} alone", f"body {i} of other words number {i * 7}") for i in range(40)]
    store.add(spark.createDataFrame([(10, "p0", "road works north", BODY), (11, "p1", "road works north", BODY), *other], NOTICE), 0)
    declared = "notice_id bigint, duplicate_of bigint, portal_id string"
    left = store.declare(spark.createDataFrame([(1000, 10, "p9"), (1001, 10, "p0"), (2049, 77, "p9"), (11, 100, "p7")], declared), 1)
    assert [tuple(r) for r in left.collect()] == [(2049, 77, "p9")]
    row = "notice_id bigint, portal_id string, card_id string, created_at timestamp"
    for k in range(2, 50):
        store._commit({"card_map": spark.createDataFrame([(1000 + k, "p9", "CARD-10", None)], row)}, k)
    assert store.cards().where("card_id = 'CARD-10'").first()[1:] == (10, 52, 3)
    assert len(store.folders) <= 13 and len(store._lists()) <= 2
    on_disk = {p.parent.parent.name.removeprefix("part=") for p in (tmp_path / "store" / "card_map").rglob("*.parquet")}
    assert on_disk == set(store.folders)
    kept = len(list((tmp_path / "store").rglob("*.parquet")))
    assert kept <= 4 * 8 + 12

    again = arrivals.CardStore(spark, str(tmp_path / "store"), slots=7)
    assert again.slots == 8 and again.folders == store.folders
    asked = spark.createDataFrame([(1001,)], "notice_id bigint")
    rows = again.of_notices("card_map", asked)
    assert re.search(r"PartitionFilters: \[[^\]]*slot", rows._jdf.queryExecution().toString())
    read = lake.files_read(again._read("card_map", again._slots_of(asked, "notice_id"))).first()["files"]
    assert 1 <= read <= len(again.folders) and rows.first()["card_id"] == "CARD-10"
    keys = banding.buckets(signed(spark.createDataFrame([(5, "p2", "road works north", BODY)], NOTICE)))
    assert {r["notice_id"] for r in again.lookup(keys).collect()} == {10, 11}
    again.add(spark.createDataFrame([(5, "p2", "road works north", BODY)], NOTICE), 50)
    assert again.card_map().where("notice_id = 5").first()["card_id"] == "CARD-10"


def test_index_lookup(spark, sets, rows, tmp_path):
    index = banding.store_index(banding.bucket_index(sets), str(tmp_path / "index"), 4, row_group_bytes=1 << 10)
    row = rows[1]
    key = "_".join(f"{v:016x}" for v in row["signature"][:4])
    found = banding.lookup(index, spark.createDataFrame([(0, key)], "band_id int, bucket_hash string"))
    expected = {i for i, r in rows.items() if r["signature"][:4] == row["signature"][:4]}
    assert {r["notice_id"] for r in found.collect()} == expected
    assert not spark.catalog.listTables()

    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = banding.lookup(index, banding.bucket_index(sets).where("notice_id % 20 = 0")).select("notice_id")
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    stored_side = text[text.index("SortMergeJoin") :].split("Bucketed: true")[0]
    assert "Bucketed: true" in text and "Exchange" not in stored_side and text.count("Exchange") <= 2
    one = index.where(f"entry = '0:{key}'")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        assert "SelectedBucketsCount: 1 out of 4" in one._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")

    import pyarrow.parquet as pq

    groups = skipped = 0
    for file in (tmp_path / "index").glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for k in range(meta.num_row_groups):
            column = next(c for c in (meta.row_group(k).column(j) for j in range(meta.num_columns)) if c.path_in_schema == "entry")
            groups += 1
            skipped += not column.statistics.min <= f"0:{key}" <= column.statistics.max
    assert groups > 8 and skipped >= groups - 6


# ---- ordered computations and evaluation ----------------------------------------------------


def test_percentiles_and_running_totals(spark):
    rng = random.Random(3)
    values = [round(rng.random() ** 3, 3) for _ in range(500)]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "g int, v double")
    for row in percentiles(df, "v", {"a": 0.05, "b": 0.5, "c": 0.99}, by=["g"], ranges=16).collect():
        mine = values[row["g"]::2]
        assert np.allclose([row["a"], row["b"], row["c"]], np.percentile(mine, [5, 50, 99]))
    folded = folded_by_value(df, "v", {"n": F.lit(1)})
    ran = {r["v"]: r["cum_n"] for r in cumulative(folded, "v", ["n"], ranges=16).collect()}
    assert all(ran[v] == sum(x >= v for x in values) for v in set(values))


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        same = rng.random() < 0.3
        rows.append((i, i + 1, same, round(min(1.0, max(0.0, rng.gauss(0.6 if same else 0.35, 0.15))), 2)))
    return spark.createDataFrame(rows, "id_a bigint, id_b bigint, is_same boolean, s double"), rows


def macro_f1(rows, tau):
    def f1(tp, fp, fn):
        return 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0

    tp = sum(r[2] and r[3] >= tau for r in rows)
    fp = sum(not r[2] and r[3] >= tau for r in rows)
    fn = sum(r[2] and r[3] < tau for r in rows)
    tn = len(rows) - tp - fp - fn
    return (f1(tp, fp, fn) + f1(tn, fn, fp)) / 2


def test_best_threshold_and_areas(scored):
    df, rows = scored
    best = E.best_threshold(df, "s").first()
    scores = {t: macro_f1(rows, t) for t in {r[3] for r in rows}}
    top = max(scores.values())
    assert best["macro_f1"] == pytest.approx(top)
    assert best["best_score"] == min(t for t, f in scores.items() if abs(f - top) < 1e-12)
    pos, neg = [r[3] for r in rows if r[2]], [r[3] for r in rows if not r[2]]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert E.roc_auc(df, "s").first()["roc_auc"] == pytest.approx(wins)
    points, area, last = [], 0.0, (0.0, 1.0)
    for t in sorted({r[3] for r in rows}, reverse=True):
        said = [r for r in rows if r[3] >= t]
        hit = sum(r[2] for r in said)
        points.append((hit / len(pos), hit / len(said)))
    for point in points:
        area += (point[0] - last[0]) * (point[1] + last[1]) / 2
        last = point
    assert E.pr_auc(df, "s").first()["pr_auc"] == pytest.approx(area)


def test_separated_classes_use_the_middle_of_the_gap(spark):
    df = spark.createDataFrame([(1, 2, True, 0.8), (1, 3, True, 0.9), (2, 3, False, 0.4)], "id_a int, id_b int, is_same boolean, s double")
    row = E.best_threshold(df, "s").first()
    assert row["threshold"] == pytest.approx(0.6) and row["macro_f1"] == 1.0


def band_work(rows, cap):
    buckets = {}
    for i, row in rows.items():
        for band in range(32):
            buckets.setdefault((band, tuple(row["signature"][4 * band: 4 * band + 4])), []).append(i)
    work, left = {i: 0 for i in rows}, [0, 0]
    for members in buckets.values():
        others = {i: sum(rows[i]["portal_id"] != rows[j]["portal_id"] for j in members) for i in members}
        if cap and len(members) > cap:
            left = [left[0] + 1, left[1] + sum(others.values()) // 2]
        else:
            for i in members:
                work[i] += others[i]
    return work, left


def test_work_and_caps(spark, sets, rows):
    labelled = spark.createDataFrame([(a, b, True) for a, b in true_edges(rows)], "id_a bigint, id_b bigint, is_same boolean")
    sweep = {r["cap"]: r for r in E.cap_sweep(sets, labelled, (20, 10, 3)).collect()}
    for cap in (0, 3, 10, 20):
        work, left = band_work(rows, cap)
        assert sweep[cap]["comparisons"] == sum(work.values()) // 2 and sweep[cap]["max_work"] == max(work.values())
        assert sweep[cap]["p90"] == pytest.approx(np.percentile(list(work.values()), 90))
        assert [sweep[cap]["skipped_buckets"], sweep[cap]["skipped_comparisons"]] == left
    found = [sweep[c]["found"] for c in (3, 10, 20, 0)]
    assert found == sorted(found) and sweep[0]["recall_pct"] == 100.0 and sweep[3]["skipped_buckets"] > 0


def test_holdout_covers_every_pair(scored):
    df, rows = scored
    judged = E.holdout_threshold(df, "s").collect()
    assert len(judged) == 2 and sum(r["tp"] + r["fp"] + r["fn"] + r["tn"] for r in judged) == len(rows)


def test_scored_pairs_are_those_of_the_pool_without_shuffled_sets(spark):
    """Repeated and missing ids, empty texts and a crowded hash; rooms and tiles of a few rows."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(30)]
    body = lambda: " ".join(["start here now", *(rng.choice(words) for _ in range(6))])
    rows = [(k, "p", "A title " + rng.choice(words), body()) for k in range(-3, 60) if k % 7]
    rows += [(k, "p", f"T {k}", "one two three four") for k in range(100, 140, 2)]
    rows += [(4, "q", "Another title", body()), (5, "q", "Another title", None), (None, "p", "x", body()), (200, None, None, None), (201, "p", "", "")]
    notices = spark.createDataFrame(rows, "notice_id bigint, portal_id string, title string, body string")
    sets = materialise(with_signatures(hashed(notices)), "sets")
    raw = notices.where("notice_id is not null").select("notice_id", hash_grams(raw_shingles()).alias("raw_set"))
    pairs = N.labelled(sets)
    plain = matching.exact_scores(pairs, sets)
    with_raw = matching.both_sides(plain, raw, ["raw_set"]).withColumn("raw_similarity", jaccard(F.col("raw_set_a"), F.col("raw_set_b")))
    tuples = lambda df, columns: sorted(tuple(r) for r in df.select(*columns).collect())
    for stated, is_raw in ((plain, False), (with_raw, True)):
        found = N.scored_pairs(notices, is_raw, room=8, hot=5)
        assert tuples(stated, found.columns) == tuples(found, found.columns) and stated.count() > 80
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "_set" not in plan


def stored_documents(spark, folder, rows):
    """Notices ``(notice_id, portal_id, title, body)`` as the table ``documents``; titles end where the body begins."""
    made = [(i, f"{title}. {body}", "en", portal, len(title) + 2 + len(body)) for i, portal, title, body in rows]
    spark.createDataFrame(made, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


def test_every_notice_is_a_probe_and_copies_are_candidates(spark, tmp_path):
    from ledgerloom.plans import notices

    rows = corpus()
    found = notices.probe_expansion(spark, stored_documents(spark, tmp_path, rows)).collect()
    signatures = as_dict(N.signed_notices(spark, str(tmp_path)))
    pairs = band_pairs(signatures, across=False)
    assert {tuple(r) for r in found} == {p for a, b in pairs for p in ((a, b), (b, a))} and len(found) == 2 * len(pairs)
    copies = [r["notice_id"] for r in signatures.values() if r["text_key"] == signatures[rows[-1][0]]["text_key"]]
    assert len(copies) > 2 and all((a, b) in {tuple(r) for r in found} for a in copies for b in copies if a != b)


def test_estimates_of_words_in_rooms_equal_those_of_joined_signatures(spark):
    from ledgerloom.functions.similarity import composite, estimated_jaccard
    from ledgerloom.operators.signatures import worded

    rows = corpus()
    notices = spark.createDataFrame([*rows, rows[3]], NOTICE)
    ids = [r[0] for r in rows]
    pairs = spark.createDataFrame([(a, b, a * 0.5) for a in ids for b in ids if a < b and (a + b) % 3 == 0], "id_a bigint, id_b bigint, similarity double")
    wide = with_signatures(hashed(notices), 16, interleaved=False)
    joined = matching.both_sides(pairs, wide, ["title_sig", "body_sig"])
    cut = lambda c, k: F.slice(c, 1, k)
    want = [
        row for k in (2, 5, 16) for row in joined.select("id_a", "id_b", "similarity", F.lit(k), composite(*[
            estimated_jaccard(cut(F.col(f"{c}_a"), k), cut(F.col(f"{c}_b"), k)) for c in ("title_sig", "body_sig")
        ])).collect()
    ]
    found = E.estimates_by_size(pairs, worded(notices), (2, 5, 16), room=7)
    assert found.columns == ["id_a", "id_b", "similarity", "k", "estimate"]
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, want)) and len(want) > 3 * pairs.count()
    assert "_sig" not in found._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_a_crowd_meet_in_rooms_and_ends_alone_are_shuffled(spark, monkeypatch):
    from ledgerloom.operators import rooms

    sets = signed(spark.createDataFrame([*template(60), *[(k, "p0", f"no pair {k}", "") for k in range(9000, 9040)]], NOTICE))
    by_id = as_dict(sets)
    listed = [(a, b) for a in range(61) for b in range(a + 1, 61) if (a * b) % 4 != 1]
    pairs = spark.createDataFrame(listed, "id_a bigint, id_b bigint")
    placed = rooms.by_partner(pairs, room=8).select("id_b", "room").distinct().collect()
    assert len(placed) == 60 and len({r["room"] for r in placed}) > 3
    kept = {r["notice_id"] for r in rooms.held_by(sets, pairs.select(F.col("id_a").alias("notice_id"))).collect()}
    assert kept >= {a for a, _ in listed} and not kept & set(range(9000, 9040))
    plain = {tuple(r) for r in matching.exact_scores(pairs, sets).where(F.col("similarity") >= 0.7).collect()}
    found = rooms.compared(pairs, sets, ["title_set", "body_set"], matching._verifying(0.7, 0.5), "title_sim double, body_sim double, similarity double")
    assert {tuple(r) for r in found.collect()} == plain and 0 < len(plain) < len(listed)
    met = matching.screen(pairs, sets, 0.5, (32, 4)).collect()
    found = rooms.compared(pairs, sets, ["signature"], matching._screening(0.5, 32, 4), "screen_score double").collect()
    assert {tuple(r) for r in found} == {tuple(r) for r in met} and len(by_id) == 101
    known = matching.links(sets, passed=matching.screened(sets)).collect()
    assert {tuple(r) for r in known} == {tuple(r) for r in matching.links(sets).collect()}


@pytest.mark.parametrize("across", ["portal_id", None])
def test_work_recall_and_partners_from_rows_of_shared_buckets(spark, sets, rows, across):
    shared = banding.shared_rows(sets, "portal_id")
    held = Counter((r["band_id"], str(r["bucket"])) for r in shared.collect())
    assert min(held.values()) > 1 and all(held[r["band_id"], str(r["bucket"])] == r["n"] for r in shared.collect())
    singles = Counter((band, tuple(row["signature"][4 * band : 4 * band + 4])) for row in rows.values() for band in range(32))
    assert sum(held.values()) == sum(n for n in singles.values() if n > 1) and 1 in singles.values()
    work = {r["notice_id"]: r["work"] for r in E.work_per_notice(sets, across, shared=shared).collect()}
    met = lambda a, b: sum(rows[a]["signature"][4 * k : 4 * k + 4] == rows[b]["signature"][4 * k : 4 * k + 4] for k in range(32))
    other = lambda a, b: a != b and (not across or rows[a]["portal_id"] != rows[b]["portal_id"])
    assert work == {a: sum(met(a, b) for b in rows if other(a, b)) for a in rows}
    plan = E.work_per_notice(sets, across, shared=shared)._jdf.queryExecution().executedPlan().toString()
    assert "signature" not in plan


def test_rows_of_a_repeated_id_are_combined_as_in_joins(spark):
    rows = [(1, "p0", "a title of words", BODY), (2, "p1", "a title of words", f"{BODY} again"), (2, "p1", "a title of words", f"{BODY} again")]
    sets = signed(spark.createDataFrame(rows, NOTICE))
    assert [(r["id_a"], r["id_b"]) for r in matching.screened(sets).collect()] == [(1, 2)] * 4
    assert [(r["id_a"], r["id_b"]) for r in matching.links(sets, passed=matching.screened(sets)).collect()] == [(1, 2)] * 8

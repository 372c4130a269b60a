import hashlib
import hmac
import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from jobloom.functions import ages, links, names, urls
from jobloom.operators import components, dedup, joins, metrics, ranking, rules, state


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize("text, want", [("  Zürich & Söhne GmbH", "zurich sohne"), ("The Co-Founder Inc.", "founder"), (None, ""), ("", ""), ("ﾊ", "")])
def test_normalize_text(spark, text, want):
    assert one(spark, text, names.normalize_text) == want


@pytest.mark.parametrize("text, want", [("Group Nine Inc. LLC", "group nine"), ("Inc", "inc"), (None, "")])
def test_company_name_only_at_the_end(spark, text, want):
    assert one(spark, text, names.company_name) == want


@pytest.mark.parametrize("text, low, high", [("11-50", 11, 50), ("1,000+", 1000, None), ("about 20 people", 20, 20), (None, None, None), ("many", None, None)])
def test_employee_range(spark, text, low, high):
    assert tuple(one(spark, text, names.employee_range)) == (low, high)


def test_hmac(spark):
    for key in (b"k", b"x" * 100):
        assert one(spark, "a text", lambda c, k=key: names.hmac_sha256(c, k)) == hmac.new(key, b"a text", hashlib.sha256).hexdigest()


def test_html_text_and_links(spark):
    page = "<p>One &amp; two</p><script>x()</script><a href='/a'>A</a><a href=\"/b\">B</a><a href='/a'>A</a>"
    assert one(spark, page, names.html_to_text) == "One & two\nA\nB\nA"
    assert "x()" in one(spark, page, lambda c: names.html_to_text(c, skip_scripts=False))
    assert one(spark, page, names.link_targets) == ["/a", "/b"]
    assert one(spark, None, names.link_targets) == []
    assert one(spark, "mail ann@corp.example or see www.other.example.", names.emails_and_domains) == ["corp.example", "www.other.example"]


@pytest.mark.parametrize("url, want", [("https://jobs.corp.co.uk/x", "corp.co.uk"), ("careers.a-b.example", "a-b.example"), ("http://10.0.0.1/x", None), ("", None), (None, None), ("nohost", None)])
def test_company_domain(spark, url, want):
    assert one(spark, url, urls.company_domain) == want


def test_tracking_and_board_references(spark):
    assert one(spark, "https://a.example/x?utm_source=q&id=3&gclid=z", urls.without_tracking) == "https://a.example/x?id=3"
    assert tuple(one(spark, "https://jobs.lever.co/acme/1", urls.board_reference)) == ("lever", "acme")
    assert one(spark, "https://acme.example/1", urls.board_reference) is None


@pytest.mark.parametrize(
    "a, b",
    [("https://WWW.A.example:443/x%2Dy/?utm_x=1&b=2#top", "http://a.example/x-y?b=2"), ("https://a.example/x//y/", "a.example/x/y"), ("https://a.example/p?b=1&a=2", "https://a.example/p?a=2&b=1")],
)
def test_canonical_page(spark, a, b):
    assert one(spark, a, links.canonical_page) == one(spark, b, links.canonical_page)
    assert one(spark, " ", links.canonical_page) is None


@pytest.mark.parametrize("url, want", [("https://boards.greenhouse.example/x/jobs/5100037", "greenhouse:5100037"), ("https://www.x.example/careers?gh_jid=5100037&gh_src=b", "greenhouse:5100037"), ("https://a.b.example/jobs/some-role-0012345/", "b.example:12345"), ("https://a.example/jobs/12", None), (None, None)])
def test_provider_number(spark, url, want):
    assert one(spark, url, links.provider_number) == want


@pytest.mark.parametrize("text, want", [("#1200", "1200"), ("ROK_1200", "1200"), (" 0001200.0", "1200"), ("a-b", "a-b"), ("", None), (None, None), ("0", "0")])
def test_posting_id(spark, text, want):
    assert one(spark, text, links.posting_id) == want


def test_ages(spark):
    day = 86_400_000_000
    df = spark.createDataFrame([(None,), (-5,), (day - 1,), (14 * day,), (15 * day,), (91 * day,)], "a bigint")
    got = [(r.d, r.t) for r in df.select(ages.age_days(F.lit(0), F.col("a")).alias("d")).select("d", ages.age_tier(F.col("d")).alias("t")).collect()]
    assert got == [(0, "fresh"), (0, "fresh"), (0, "fresh"), (14, "fresh"), (15, "recent"), (91, "expired")] or got[1:] == [(0, "fresh"), (0, "fresh"), (14, "fresh"), (15, "recent"), (91, "expired")]


def test_first_reason_is_the_first(spark):
    df = spark.createDataFrame([(1, None), (5, "x"), (20, "x"), (None, None)], "a int, reason_text string")
    r = [("s1", "big", F.col("a") > 10), ("s2", "named", F.col("reason_text").isNotNull()), ("s3", "never", F.lit(None).cast("boolean"))]
    out = rules.cascade(df, r)
    assert [(x.a, x.stat, x.reason) for x in out.collect()] == [(1, None, None), (5, "s2", "named"), (20, "s1", "big"), (None, None, None)]
    kept, rejected = rules.split_by_reason(out)
    assert kept.count() + rejected.count() == df.count()
    assert rules.cascade(df.limit(0), r).count() == 0


def test_decide_over_all_states(spark):
    ranks = {"PASS": 0, "NEEDS_CHECK": 1, "REROUTE": 2, "UNVERIFIED": 3, "REJECT": 4}
    states = [*ranks, "strange"]
    rows = [(i, [(f"g{n}", s, f"r-{s}") for n, s in enumerate(combo)]) for i, combo in enumerate(product(states, repeat=3))]
    df = spark.createDataFrame(rows, "i int, gates array<struct<gate:string,state:string,reason:string>>")
    for r in df.withColumn("v", rules.decide(F.col("gates"), ranks)).collect():
        order = sorted(range(3), key=lambda n: (-ranks.get(r.gates[n].state, 99), n))
        top = r.gates[order[0]]
        assert (r.v.state, r.v.gate, r.v.primary_reason) == (top.state, top.gate, top.reason)
        assert r.v.reasons == list(dict.fromkeys(r.gates[n].reason for n in order))
    empty = spark.createDataFrame([([],), (None,)], "gates array<struct<gate:string,state:string,reason:string>>")
    assert [r.v for r in empty.select(rules.decide(F.col("gates"), ranks).alias("v")).collect()] == [None, None]


def test_components_equal_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(110)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.label for r in components.min_labels(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in parent}
    assert components.min_labels(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_contained_names_equal_nested_loop(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(4, 12)))
    a, b = {word() for _ in range(80)}, {word() for _ in range(80)}
    a |= {x[1:] for x in list(b)[:20]}
    got = {tuple(r) for r in joins.contained_names(spark.createDataFrame([(x,) for x in a], "name string"), spark.createDataFrame([(x,) for x in b], "listed_name string")).collect()}
    want = {(x, y) for x in a for y in b if min(len(x), len(y)) >= 5 and (x in y or y in x) and min(len(x), len(y)) >= 0.88 * max(len(x), len(y))}
    assert got == want


def test_groups_and_propagation(spark):
    df = spark.createDataFrame([("a", "x", None), ("a", None, True), ("b", "y", False), ("b", "z", None), (None, None, None), ("c", None, None)], "g string, v string, hit boolean")
    assert {r.g for r in joins.exclude_whole_group(df, "g", F.col("hit")).collect()} == {"b", None, "c"}
    assert sorted((r.g or "", r.v or "") for r in joins.propagate_unique(df, "g", "v").collect()) == [("", ""), ("a", "x"), ("a", "x"), ("b", "y"), ("b", "z"), ("c", "")]


def test_manifest_diff(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "k int, v string, n int")
    new = spark.createDataFrame([(1, "a", None), (2, "b", 2), (4, "d", 1)], "k int, v string, n int")
    got = {tuple(r) for r in joins.manifest_diff(old, new, "k", ["v", "n"]).collect()}
    assert got == {(2, "changed", "n"), (3, "missing", ""), (4, "new", "")}
    with pytest.raises(ValueError):
        joins.manifest_diff(old.union(old), new, "k", ["v"])
    assert joins.closed_alias({"a": "b", "b": "c", "x": "y", "y": "x"}) == {"a": "c", "b": "c", "x": "x", "y": "x"}


def test_sequential_merge_equals_a_plain_fold(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        title = rng.choice(["t", "u"])
        keys = sorted({f"{title}{rng.randrange(9)}" for _ in range(rng.randrange(1, 3))})
        rows.append((title, i, i, keys, rng.randrange(3), rng.choice("pq")))
    want = set()
    for title in ("t", "u"):
        for s in dedup._fold([(o, r, k, st, so) for t, o, r, k, st, so in rows if t == title]):
            want.add((title, s["winner"], tuple(s["members"])))
    df = spark.createDataFrame(rows, "title string, ord bigint, row_id bigint, keys array<string>, strength int, source string")
    assert {(r.title, r.winner, tuple(r.members)) for r in dedup.sequential_merge(df).collect()} == want


def test_dispositions_and_ladder(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "o int, k string")
    seen = spark.createDataFrame([("b",), ("b",)], "k string")
    assert {r.o: r.disposition for r in dedup.dispositions(df, "k", "o", seen).collect()} == {1: "kept", 2: "duplicate", 3: "seen", 4: "kept", 5: "kept"}
    t = spark.createDataFrame([("7", "u"), (" ", "u"), (None, None)], "id string, url string")
    key, strength = dedup.identity_ladder(F.col("id"), F.col("url"), [F.lit("A"), F.col("url")])
    assert [r.s for r in t.select(strength.alias("s")).collect()] == ["id", "url", "digest"]
    assert t.select(key.alias("k")).collect()[2].k == "digest:" + hashlib.sha256(b"a|").hexdigest()[:32]


def test_metrics_reconcile(spark):
    df = spark.createDataFrame([("s", ["t"], 1), ("s", None, 5), ("t", ["s", "t"], 9), (None, [], None)], "source string, others array<string>, v int")
    out = {r.source: (r["rows"], r.as_primary, r.big) for r in metrics.source_outcomes(df, "source", "others", {"big": F.col("v") > 4}).collect()}
    assert out == {"s": (3, 2, 2), "t": (2, 1, 1)}
    d = metrics.attribute_discards(df, "source", [("small", F.col("v") < 3), ("odd", F.col("v") % 2 == 1)], [("many", F.size("others") > 1)]).collect()
    assert all(r.entered == r.small + r.odd + r.kept for r in d)
    none = metrics.baselines(df.select("source"), "source", None).first()
    assert none.previously_seen is None and none.incremental is None and none.gross == 4
    c = metrics.confusion(spark.createDataFrame([("x", True, None), ("x", None, True)], "s string, p boolean, g boolean"), "s", F.col("p"), F.col("g")).first()
    assert (c.precision, c.recall, c.abstain) == (None, None, 1)
    assert metrics.confusion(spark.createDataFrame([("x", None, True)], "s string, p boolean, g boolean"), "s", F.col("p"), F.col("g"), 1.0).first().recall == 1.0


def test_ranking(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 3, 2), ("b", 9, 3), ("b", 1, 4), ("c", 2, 5)], "g string, v int, i int")
    turns = ranking.interleave(df, "g", [F.desc("v"), F.asc("i")]).orderBy("turn", "group_rank").collect()
    assert [r.i for r in turns] == [3, 1, 5, 4, 2]
    assert {r.i for r in ranking.top_per_group(df, ["g"], [F.desc("v"), F.asc("i")], 1).collect()} == {1, 3, 5}
    assert one(spark, "a:b", lambda c: ranking.hash_slot(c, 3)) == int.from_bytes(hashlib.sha256(b"a:b").digest()[:8], "big") % 3


def test_state(spark):
    old = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-09")], "k string, first_seen string")
    new = spark.createDataFrame([("a", "2024-01-10"), ("c", "2024-01-10"), (None, "2024-01-10")], "k string, at string")
    got = {r.k: r.first_seen for r in state.first_seen(old, new, "k", "at", 5, F.lit("2024-01-10").cast("date")).collect()}
    assert got == {"b": "2024-01-09", "c": "2024-01-10"}
    rows = spark.createDataFrame([("s", 1, "x"), ("s", 3, "y"), ("s", 3, "z"), ("t", 1, "q")], "s string, at int, id string")
    edges = state.cursor(rows.filter("id <> 'z' and s = 's'"), "s", "at", "id")
    assert {r.id for r in state.beyond_cursor(rows, edges, "s", "at", "id").collect()} == {"z", "q"}


@pytest.mark.parametrize(
    "a, b, want",
    [("Acme Tools Inc.", "ACME TOOLS", True), ("Acme", "Acme Tools Holdings", True), ("North Star Labs", "Star Labs North", True), ("Godefin Tebalen", "Godefinn Tebalen", True), ("Acme", "Acne", False), ("", "Acme", False), (None, None, False)],
)
def test_compatible_names(spark, a, b, want):
    from jobloom.functions.similarity import compatible

    assert spark.createDataFrame([(a, b)], "a string, b string").select(compatible(F.col("a"), F.col("b")).alias("c")).first().c is want


@pytest.mark.parametrize("domain, name, want", [("acme.example", "Acme Inc", True), ("northstar.example", "North Star Labs", True), ("getacmetools.example", "Tools Acme", True), ("other.example", "Acme", False), (None, "Acme", False), ("acme.example", None, False)])
def test_domain_fits_name(spark, domain, name, want):
    from jobloom.functions.similarity import domain_fits_name

    assert spark.createDataFrame([(domain, name)], "a string, b string").select(domain_fits_name(F.col("a"), F.col("b")).alias("c")).first().c is want


def test_all_compatible_names_are_found(spark, small):
    from jobloom.functions.similarity import compatible
    from jobloom.plans.registry import core_queries

    left = [r[0] for r in spark.read.parquet(f"{small}/crm_companies.parquet").select("Company").distinct().collect()]
    right = [r[0] for r in spark.read.parquet(f"{small}/boards_final.parquet").select("company_name").distinct().collect()]
    # First words that are mistyped, joined or elsewhere.
    left += ["Bolofol Nuzurar Software", "Godefinn Tebalen", "North Star Labs", "Abcdefghijkl", "a", "", None]
    right += ["Nuzurar Bolofol Software Inc.", "Godefin Tebalen", "NorthStar Labs", "Abcdeghijkl", "Bbcdefghijkl", "A", " ", None]
    a, b = spark.createDataFrame([(x,) for x in left], "x string"), spark.createDataFrame([(y,) for y in right], "y string")
    name = lambda c: names.company_name(F.col(c))
    want = {tuple(r) for r in a.crossJoin(b).filter(compatible(F.col("x"), F.col("y"))).select(name("x"), name("y")).collect()}
    rows = [tuple(r) for r in joins.compatible_pairs(a, b).collect()]
    assert set(rows) == want and len(rows) == len(want)
    assert {("bolofol nuzurar software", "nuzurar bolofol software"), ("godefinn tebalen", "godefin tebalen"), ("north star labs", "northstar labs"), ("abcdefghijkl", "bbcdefghijkl")} <= want
    found = {tuple(r) for r in core_queries()["q_all_compatible_names"](spark, small).collect()}
    assert {tuple(r)[:2] for r in core_queries()["q_compatible_names"](spark, small).filter("compatible").collect()} <= found <= want


def test_pieces_of_names_are_never_broadcast(spark):
    a, b = (spark.createDataFrame([(f"godefin {n} tebalen",) for n in "abcde"], f"{c} string") for c in "xy")
    pairs = joins.compatible_pairs(a, b)
    # Names are small enough for a broadcast, their pieces are a hundred times as large.
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert pairs.count() == 25


def test_witnesses_differ_by_their_whole_text(spark):
    long = "x" * 20_000
    rows = spark.createDataFrame([("a", long + "1", "h"), ("a", long + "2", "i"), ("b", long, "h"), ("b", long, "i")], "k string, t string, host string")
    assert [tuple(r) for r in joins.enough_witnesses(rows, "k", "t", "host", 2).collect()] == [("a", 2)]

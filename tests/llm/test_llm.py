import random
import re
import time
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import private_holdout
from jobloom.llm import canonical, crf, encoding, incremental, leaks, names, openings, private, quality, queries

names_write_cut = names.write_cut


def read(spark, d, t):
    return spark.read.parquet(f"{d}/{t}.parquet")


# ---------------------------------------------------------------- every query


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_runs_and_repeats_no_row(spark, small, name):
    df = queries.queries()[name](spark, small)
    rows = [tuple(str(x) for x in r) for r in df.collect()]
    assert len(rows) == len(set(rows))


COLUMNS = {
    "p1_found": ["row_id", "kind", "start_pos"], "p2_found": ["spelling_a", "spelling_b"], "p3_found": ["row_id_a", "row_id_b"], "p5_found": ["row_id_a", "row_id_b"],
    "p7_found": ["row_id", "role_id"], "p8_ids": ["doc_id", "ids"], "p9_found": ["item_id", "doc_id"], "p10_found": ["doc_id", "kind"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns(spark, small, name):
    assert queries.queries()[name](spark, small).columns == COLUMNS[name]


# ---------------------------------------------------------------- private values


@pytest.fixture(scope="module")
def field():
    return private.trained()


def hand_labelled():
    """(text, {(start, kind)}) of the texts written by hand."""
    for line in re.split(r"\n(?!\[\[N:[^\]]*\]\]\n)", private_holdout.TEXTS.strip()):
        text, want, at = "", set(), 0
        for m in re.finditer(r"\[\[(\w):([^\]]*)\]\]", line):
            text += line[at : m.start()]
            want.add((len(text), private_holdout.KINDS[m[1]]))
            text, at = text + m[2], m.end()
        yield text + line[at:], want


def test_texts_written_by_hand(field):
    tagger = crf.Tagger(field)
    right = found = wanted = 0
    for text, want in hand_labelled():
        got = {(a, private.table.KINDS[k]) for a, _, k in private.values(text, tagger.tag([text])[0])}
        right, found, wanted = right + len(got & want), found + len(got), wanted + len(want)
    assert right >= 0.9 * wanted and right >= 0.95 * found


def test_fresh_values_of_the_table(field):
    held = private.labelled_texts(400, seed=5)
    tagger = crf.Tagger(field)
    right = wrong = missed = 0
    for (text, spans), stretches in zip(held, tagger.tag([t for t, _ in held])):
        want = {(a, k) for a, _, k in spans}
        got = {(a, k) for a, _, k in private.values(text, stretches)}
        right, wrong, missed = right + len(got & want), wrong + len(got - want), missed + len(want - got)
    assert right / (right + wrong) > 0.95 and right / (right + missed) > 0.92


def test_the_labelled_table_is_independent(spark, small):
    """No private value and no sentence of the table stands in the tables it is tried on, nor in the texts written by hand."""
    descriptions = queries._descriptions(spark, small)
    texts = "\n".join([r.text for r in descriptions.collect()] + [t for t, want in hand_labelled() if want])
    known = set(re.findall(r"\w+", texts))
    values = private.table.VALUES
    assert not known & {w for k in ("first name", "surname") for w in re.findall(r"\w{4,}", values[k])}
    for k in ("street", "email domain", "german street", "french name", "spanish name"):
        assert not [v for v in map(str.strip, values[k].split("|")) if len(v) > 8 and re.search(rf"(?<!\w){re.escape(v)}(?!\w)", texts)]
    stems = {m[1] for m in re.finditer(r"(\w+?)(?:straße|strasse|str\.|weg|platz|allee|gasse)\b", texts)}
    assert not stems & set(map(str.strip, values["strasse"].split("|")))
    for frame in private.table.FRAMES + [p for p in private.table.PLAIN if "{" in p]:
        if len(re.sub(r"\{[a-z_ ]+\}", "", frame)) > 18:
            pattern = re.sub(r"\\\{[a-z_\\ ]+\\\}", ".{2,40}", re.escape(frame.replace("\\n", "\n"))).replace("\\#", r"\d")
            assert not re.search(rf"(?m)(?:^|[.?!] ){pattern}", texts), frame


def test_pruned_decoding_is_full_decoding(field):
    tagger = crf.Tagger(field)
    for text, _ in private.labelled_texts(60, seed=8):
        tokens = crf.TOKEN.findall(text)
        rows = [field.rows(t) for t in tokens]
        scores = np.zeros((len(tokens), len(field.labels)), dtype=np.float32)
        for i in range(len(tokens)):
            for o, offset in enumerate(crf.OFFSETS):
                if 0 <= i + offset < len(tokens):
                    scores[i] += rows[i + offset][o]
        full = field.viterbi([scores])[0]
        part = np.zeros(len(tokens), dtype=np.int8)
        for first, labels in tagger.tag([text])[0]:
            part[first : first + len(labels)] = labels
        assert (full == part).all()


def test_numbers_are_told_by_their_labels(field):
    tagger = crf.Tagger(field)
    kinds = lambda t: [(a, private.table.KINDS[k]) for a, _, k in private.values(t, tagger.tag([t])[0])]
    assert kinds("(social security number 935 63 5646 on file)") == [(24, "id_number")]
    assert kinds("Order number 935-63-5646 left the warehouse.") == []


def test_redaction_keeps_the_rest(spark):
    text = "Working hours are flexible.\nApplications: ann.lindmoor@mail.example\n"
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "x " * 60_000), (1, text)], "row_id bigint, text string").withColumn("kind", F.lit("clash"))
    out = [r.text for r in private.redacted(df).collect()]
    assert out[0] == "Working hours are flexible.\nApplications: [EMAIL]\n" and out[1:4] == ["", None, "x " * 60_000] and out[4] == out[0]
    assert private.found_values(df.limit(0)).count() == 0


# ---------------------------------------------------------------- names


@pytest.mark.parametrize(
    "a, b, same",
    [
        ("Godefin Tebalen Logistics Inc.", "GODEEFIN TEBALEN", True), ("GodTebalen", "Godefin Tebalen", True), ("Retail, Zalosi Muzobi", "Muzobi Zalosi Retail", True), ("The Mihedun Denenal Biotech Team", "Mihedun  Denenal Biot.", True),
        ("Kem. Doduver Educstion", "Kemusil Doduver Education", True), ("Lunivir-Hogibo Media", "Lunivír Hogibo Media LLC", True), ("Nofari Kelusa Media", "Nofari Kelusa Energy", False), ("Godefin Tebalen", "Godefin Sirubel", False),
    ],
)
def test_pairs_of_spellings(spark, small, a, b, same):
    # The lines of business are learned from the other spellings.
    others = [f"Name{n} Other{n} {line}" for n in range(3) for line in ("Logistics", "Retail", "Biotech", "Education", "Media", "Energy")]
    df = spark.createDataFrame([(x,) for x in (a, b, a, None, " ", "Confidential", *others)], "c string")
    got = {tuple(r) for r in names.same_organisation([(df, "c")]).collect() if "Other" not in r[0] + r[1]}
    assert got == ({tuple(sorted((a, b)))} if same else set())


def folded_names(spark, small):
    every = names.spellings([(read(spark, small, "sources"), "company")])
    lines = names.lines_of_business(every)
    return {p[0] for r in every.collect() if (p := names.parse(r.spelling, lines))}


def test_lines_of_business_are_learned(spark):
    words = ["Ato Bero Kitchens", "Kitchens, Mila Sorn", "Dova Pell Kitchens Inc.", "Runo Kest Kichens", "Sala Morn Bakery", "Ulo Vint Bakery", "Bakery - Zora Lund"]
    df = spark.createDataFrame([(w,) for w in words], "spelling string")
    assert names.lines_of_business(df).words == {"kitchens", "bakery"}
    assert names.parse("Foster Kitchns", names.lines_of_business(df)) == ("foster", "kitchens")
    assert names.lines_of_business(df.limit(0)).words == frozenset()


def test_keys_without_a_partner_are_left_out_before_the_join(spark, monkeypatch):
    written = {}
    monkeypatch.setattr(names, "write_cut", lambda df, name: written.setdefault(name, names_write_cut(df, name)))
    rows = names.similar_names(spark.createDataFrame([("bolofol nuzurar",), ("bolofol nuzurra",), ("kidemap",)], "name string")).collect()
    assert [tuple(r)[:2] for r in rows] == [("bolofol nuzurar", "bolofol nuzurra")]
    kept = written["keys"].groupBy("key").count()
    assert kept.count() > 0 and kept.filter("count < 2").count() == 0


def test_name_join_misses_no_pair(spark, small):
    every = folded_names(spark, small)
    every |= {"kol mmoizo", "kolemon momizo", "rez zisunu", "rezogen zidunu", "gimadu nufoges", "gimaud nuofges", "momizokolemon", "kolmomizo", "zidnuu", "zid", "ab cd ef", "abc cd efg", "ab longword", "abcdef lo"}
    got = {(r.a, r.b) for r in names.similar_names(spark.createDataFrame([(n,) for n in sorted(every)], "name string")).collect()}
    want = {(a, b) for a, b in combinations(sorted(every), 2) if names.similarity(a, b) >= names.DIRECT}
    assert got == want and {("kol mmoizo", "kolemon momizo"), ("rez zisunu", "rezogen zidunu"), ("gimadu nufoges", "gimaud nuofges")} <= want
    assert names.same_organisation([(spark.createDataFrame([], "c string"), "c")]).count() == 0


def test_pairs_met_in_blocks_are_the_same(spark, small, monkeypatch):
    """What is on the disks at once is bounded by the postings: more pairs come in more blocks, with the same result."""
    every = spark.createDataFrame([(n,) for n in sorted(folded_names(spark, small))], "name string").cache()
    whole = {tuple(r) for r in names.similar_names(every).collect()}
    blocks = []
    monkeypatch.setattr(names, "PAIRS_A_POSTING", 0.3, raising=False)
    monkeypatch.setattr(names, "write_cut", lambda df, name: blocks.append(name) or names_write_cut(df, name))
    again = [tuple(r) for r in names.similar_names(every).collect()]
    assert len(again) == len(set(again)) and set(again) == whole and whole
    assert blocks.count("tested") > 1


def test_shuffle_files_go_with_the_write(spark):
    files = lambda: spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    before = files()
    counted = names_write_cut(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "counted")
    until = time.monotonic() + 10
    while (left := files()) > before and time.monotonic() < until:
        time.sleep(0.1)
    assert left <= before and counted.count() == 7


def test_the_nearest_by_cosine_equal_brute_force(spark, small, monkeypatch):
    every = sorted(folded_names(spark, small))[:150]
    monkeypatch.setattr(names, "_key_rows", lambda batches: (b.assign(key=0, asks=False)[["name", "key", "asks"]].iloc[:0] for b in batches))
    monkeypatch.setattr(names, "_tested", lambda batches: (b.assign(similarity=1.0) for b in batches))
    monkeypatch.setattr(names, "NEAREST", 3)
    got = {(r.a, r.b) for r in names.similar_names(spark.createDataFrame([(n,) for n in every], "name string")).collect()}
    df = {}
    for n in every:
        for g in names.grams(n):
            df[g] = df.get(g, 0) + 1
    vectors = [{g: np.log1p(len(every) / df[g]) for g in names.grams(n)} for n in every]
    norm = [np.sqrt(sum(w * w for w in v.values())) for v in vectors]
    cosine = [[sum(w * v.get(g, 0) for g, w in u.items()) / norm[i] / norm[j] for j, v in enumerate(vectors)] for i, u in enumerate(vectors)]
    for i, a in enumerate(every):
        near = sorted(((c, -j) for j, c in enumerate(cosine[i]) if j != i and c >= names.COSINE + 1e-9), reverse=True)
        if near:
            assert any(tuple(sorted((a, every[-j]))) in got for c, j in near if c > near[0][0] - 1e-9)
    for a, b in got:
        assert cosine[every.index(a)][every.index(b)] >= names.COSINE - 1e-9


def test_close_names_share_a_key():
    rng = random.Random(3)

    def slip(w):
        at = rng.randrange(len(w))
        return rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abk") + w[at:], w[:at] + rng.choice("abk") + w[at + 1 :], w[:at] + w[at : at + 2][::-1] + w[at + 2 :], w[: rng.randrange(2, 5)]]) or w

    met = 0
    for _ in range(20_000):
        a = ["".join(rng.choice("abkom") for _ in range(rng.randrange(2, 9))) for _ in range(rng.choice((1, 2, 2, 2, 3)))]
        b = [slip(slip(w)) if rng.random() < 0.3 else slip(w) if rng.random() < 0.6 else w for w in a]
        b = rng.choice([sorted(b), sorted(b), ["".join(b)], [b[0][:3] + b[-1]]])
        x, y = " ".join(sorted(a)), " ".join(b)
        if x != y and names.similarity(x, y) >= names.DIRECT:
            met += 1
            k, l = names.keys(x), names.keys(y)
            assert any(k[s] or l[s] for s in k.keys() & l.keys()), (x, y)
    assert met > 2_000


def plain_linkage(every, score, cut):
    groups = [[n] for n in every]
    average = lambda g, h: sum(score.get((min(a, b), max(a, b)), 0.0) for a in g for b in h) / (len(g) * len(h))
    while len(groups) > 1:
        s, i, j = max((average(groups[i], groups[j]), i, j) for i in range(len(groups)) for j in range(i))
        if s < cut:
            break
        groups[j] += groups.pop(i)
    return {frozenset(g) for g in groups}


def test_average_linkage(spark):
    rng = random.Random(4)
    every = [f"n{i:02d}" for i in range(40)]
    score = {(a, b): rng.random() for a, b in combinations(every, 2) if rng.random() < 0.12}  # no equal averages
    df = spark.createDataFrame([(b, a, s) for (a, b), s in score.items()], "a string, b string, similarity double")
    grouped = {}
    for r in names.average_linkage(df).collect():
        grouped.setdefault(r.grp, set()).add(r.name)
    alone = set(every) - {n for g in grouped.values() for n in g}
    assert {frozenset(g) for g in grouped.values()} | {frozenset([n]) for n in alone} == plain_linkage(every, score, names.LINKAGE)
    assert names.average_linkage(df.limit(0)).count() == 0


# ---------------------------------------------------------------- redelivered postings


def test_linkage_equals_union_find(spark, small):
    got = {tuple(r) for r in queries.p3_found(spark, small).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for name, to in (("sources", incremental.source_records), ("greenhouse_jobs", incremental.greenhouse_records)):
        first = {}
        for r in sorted(to(read(spark, small, name)).collect(), key=lambda r: r.node):
            for k in r["keys"]:
                a, b = find(first.setdefault(k, r.node)), find(r.node)
                parent[max(a, b)] = min(a, b)
    assert got == {(find(x), x) for x in parent if find(x) != x} and got


def test_batches_join_old_clusters(spark):
    rows = [(1, "7", None, 1), (2, "9", "https://a.example/jobs/55555", 1), (3, None, "https://a.example/jobs/66666", 2), (4, "9", "https://a.example/jobs/66666", 3), (5, "7", "https://a.example/jobs/55555", 4), (6, None, None, 4), (7, " ", "", None)]
    df = spark.createDataFrame(rows, "row_id bigint, id string, url string, batch_id int").withColumns({"position": F.lit("x"), "company": F.lit("y"), "location": F.lit(None).cast("string"), "key": F.lit("clash")})
    want = {(1, 2), (1, 3), (1, 4), (1, 5)}
    for single in (1, 2, 3):
        assert {tuple(r) for r in incremental.link_batches(incremental.source_records(df), spark, "batch", single).collect()} == want
    assert incremental.link_batches(incremental.source_records(df.limit(0)), spark, "batch").count() == 0


def test_state_is_stored_and_taken_up_again(spark, monkeypatch):
    rows = [(n, str(n % 17), f"https://a.example/jobs/{50000 + n % 23}" if n % 5 else None, n // 20) for n in range(120)]
    df = spark.createDataFrame(rows, "row_id bigint, id string, url string, batch_id int").withColumns({c: F.lit(c) for c in ("position", "company", "location")})
    made = incremental.source_records(df).cache()
    whole = incremental.RecordLinkage(spark)
    whole.ingest(made)
    want = {tuple(r) for r in whole.representatives().collect()}
    monkeypatch.setattr(incremental, "COMPACTED", 2)
    linkage = incremental.RecordLinkage(spark)
    read_buckets = []
    keys = incremental.RecordLinkage._keys
    monkeypatch.setattr(incremental.RecordLinkage, "_keys", lambda self, buckets: (read_buckets.append(buckets), keys(self, buckets))[1])
    for n in range(6):
        linkage.ingest(made.filter(F.col("batch") == n))
        linkage = incremental.RecordLinkage.load(spark, linkage.save())
    assert {tuple(r) for r in linkage.representatives().collect()} == want and want
    assert len(linkage.versions) <= 3 and linkage.batches == 6
    assert read_buckets[0] is None and all(0 < len(b) < incremental.BUCKETS for b in read_buckets[1:])
    linkage.ingest(made.filter("batch = 99"))
    assert {tuple(r) for r in linkage.representatives().collect()} == want


def test_each_key_alone_is_enough():
    x = np.array([[1, 0, 0, 0, 0], [0, 1, 0, 0, 0], [0, 1, 1, 1, 1], [0, 0, 1, 1, 1], [0, 0, 0, 0, 0]] * 30, dtype=float)
    y = np.array([1, 1, 1, 0, 0] * 30, dtype=float)
    w = incremental.learn_weights(x, y)
    assert (((x @ w[:-1] + w[-1]) >= 0) == (y == 1)).all()


# ---------------------------------------------------------------- openings


def test_same_openings(spark, small):
    catalog = read(spark, small, "role_catalog")
    rows = spark.createDataFrame(
        [
            ("a", 1, "Data Engr", "Godefin Tebalen Inc.", "Boston, MA"), ("a", 2, "Senior Data Engineer", "Godefin Tebalen", "Boston"), ("a", 3, "Data Engineer", "Godefin Tebalen", "Reno, NV"), ("a", 4, " ", "Godefin Tebalen", "Boston"), ("a", 5, "Tax Accountant", "Godefin Tebalen", None),
            ("a", 6, "Data Engineer", None, "Boston"), ("b", 11, "DATA ENGINEER [REMOTE]", "Godefin Tebalen", "US - Boston"), ("b", 12, "Tax Acct.", "Godefin Tebalen", "Denver (CO)"), ("b", 13, "Data Engineer", "Nofari Kelusa", "Boston"), ("b", 14, "Data Engineer", "Godefin Tebalen", "Boston"),
        ],
        "side string, row_id bigint, title string, company string, place string",
    )
    got = {(r.row_id_a, r.row_id_b) for r in openings.same_openings(rows, catalog).collect()}
    assert got == {(1, 11), (1, 14), (5, 12)}
    assert openings.same_openings(rows.limit(0), catalog).count() == 0


def opening_rows(spark, small):
    return openings.posting_rows(*(read(spark, small, t) for t in ("sources", "greenhouse_jobs", "ashby_jobs")))


def test_retrieval_equals_all_pairs(spark, small):
    records = openings.described(opening_rows(spark, small), read(spark, small, "role_catalog")).select("side", "org", "role", "city").distinct().cache()
    a, b = (records.filter(F.col("side") == s).drop("side") for s in ("a", "b"))
    index = openings.Index.of(b)
    asked = index.weighted(a).cache()
    every = asked.select("q").crossJoin(index.records.select(F.concat_ws("\t", "org", "role", "city").alias("d")))
    want = {tuple(r) for r in index.scored(every, asked).collect()}
    got = {tuple(r) for r in index.scored(index.candidates(asked), asked).collect()}
    assert got == want and want and index.candidates(asked).count() < every.count() / 20
    assert {r.score for r in index.scored(every.filter("q = d"), asked).collect()} == {1.0}
    best = {}
    for q, d, score in want:
        best.setdefault(q, []).append((-score, d))
    for r in openings.nearest(spark.createDataFrame(sorted(want), "q string, d string, score double")).collect():
        top = sorted(best[r.q])
        assert (r.d, r.score) == (top[0][1], -top[0][0]) and abs(r.lead - (-top[0][0] - (-top[1][0] if len(top) > 1 else 0.0))) < 1e-9


def test_a_shared_line_of_business_makes_no_candidates(spark):
    """Such a word stands in a fixed share of the records: lists of it, asked by as many, would grow with the square of the table."""
    rows = [(f"{x}{i:03d} {y}{i:03d}|energy", f"r:{i % 20}", "*") for i in range(150) for x, y in (("bo", "ka"), ("ma", "ti"))]
    a, b = (spark.createDataFrame(rows[i::3] + rows[1::3], "org string, role string, city string") for i in (0, 2))
    index = openings.Index.of(b)
    asked = index.weighted(a).cache()
    pairs = index.candidates(asked)
    every = asked.select("q").crossJoin(b.select(F.concat_ws("\t", "org", "role", "city").alias("d")))
    want = {tuple(r) for r in index.scored(every, asked).collect()}
    assert want and want == {tuple(r) for r in index.found(asked).collect()}
    assert pairs.count() == pairs.distinct().count() < 2 * len(rows)


def test_every_list_equals_all_pairs(spark, monkeypatch):
    """A low least score, at which records are found by each list alone."""
    monkeypatch.setattr(openings, "LEAST", 0.12)
    rng = random.Random(5)
    record = lambda: (f"{rng.choice(['ba', 'bo', 'ka', 'ko'])} {rng.choice('xyzuvw')}{rng.choice(['', '|energy', '|foods'])}", rng.choice(["r:1", "r:2", "w:blower glass", "w:clerk glass"]), rng.choice(["*", "reno", "boston", "bostn"]))
    a, b = (spark.createDataFrame(sorted({record() for _ in range(120)}), "org string, role string, city string") for _ in range(2))
    index = openings.Index.of(b)
    asked = index.weighted(a).cache()
    assert all(asked.filter(c).count() for c in ("by_both", "by_place", "by_org", "by_words", "size(rare) > 0"))
    every = asked.select("q").crossJoin(b.select(F.concat_ws("\t", "org", "role", "city").alias("d")))
    met = index.candidates(asked)
    want, got = ({tuple(r) for r in index.scored(x, asked).collect()} for x in (every, met))
    missed = {(q, d) for q, d, _ in want - got}
    assert met.count() == met.distinct().count()
    # Records that share a role or a place alone stand in no list.
    assert all(not set(re.split("[ |]", q.split("\t")[0])) & set(re.split("[ |]", d.split("\t")[0])) for q, d in missed) and got <= want


def test_a_noisy_pair_is_found_by_its_score(spark, small):
    """One slip in a place that is rare on both sides: the attributes differ, a join on them finds nothing."""
    more = [("a", 1, "Tax Accountant", "Belorun Katsimi", "Wolfenbuettel, NI"), ("b", 2, "Tax Accountant (m/f)", "Belorun Katsimi Inc.", "Wolfenbuetel"), ("a", 3, "Copywriter", "Belorun Katsimi", "Wolfenbuettel"), ("b", 4, "Copywriter", "Belorun Katsimi", "Garmisch")]
    rows = opening_rows(spark, small).unionByName(spark.createDataFrame(more, "side string, row_id bigint, title string, company string, place string"))
    catalog = read(spark, small, "role_catalog")
    records = openings.described(rows, catalog).filter("row_id < 5").collect()
    assert len({(r.org, r.role, r.city) for r in records if r.row_id < 3}) == 2
    assert {(r.row_id_a, r.row_id_b) for r in openings.same_openings(rows, catalog).filter("row_id_a < 5 or row_id_b < 5").collect()} == {(1, 2)}


@pytest.mark.parametrize("place, want", [("Boston, MA", "boston"), ("US - San Diego", "san diego"), ("Remote - Nürnberg", "nurnberg"), ("España", ""), ("Remote", ""), (None, ""), ("Salt Lake City (UT)", "salt lake city"), ("U.S. - Reno", "reno")])
def test_city(place, want):
    assert openings.city(place) == want


# ---------------------------------------------------------------- titles


def edits(a, b):
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_deletes_find_every_word_within_reach():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(4, 11))) for _ in range(150)})
    dictionary = canonical.Dictionary([(i, (w,), 0) for i, w in enumerate(words)])
    for _ in range(200):
        w = list(rng.choice(words))
        at = rng.randrange(len(w))
        w[at] = rng.choice("abcd")
        token = "".join(w)
        near = {x for x in words if edits(token, x) <= 1 and len(x) >= 4 and len(token) >= 4}
        assert near <= set(dictionary.lookup(token, False))


@pytest.mark.parametrize(
    "title, role",
    [
        ("Data Engr [Req 84100]", "Data Engineer"), ("Sr. Data Eng", "Senior Data Engineer"), ("Director – Regional Sales", "Regional Sales Director"), ("Engineer_-_Site_Reliability JR-9073", "Site Reliability Engineer"), ("Manufacturign Process Engineer", "Manufacturing Process Engineer"),
        ("EA to CEO, Denver", "Executive Assistant"), ("Senior Tax Accountant II", "Tax Accountant"), ("URGENT - mkt. coord. (Contract)", "Marketing Coordinator"), ("Contract Paralegal (Contract)", "Contract Paralegal"), ("Data Entry Clerk", None), ("Forklift Operrator | Tampa", None), ("asdf", None), ("Sales Manager", None), ("x" * 5000, None),
    ],
)
def test_titles(spark, small, title, role):
    catalog = read(spark, small, "role_catalog")
    ids = {r.canonical_title: r.role_id for r in catalog.collect()}
    df = spark.createDataFrame([(1, title), (2, title), (3, " "), (4, None)], "row_id bigint, title string").withColumn("role_id", F.lit("clash"))
    assert {r.row_id: r.role_id for r in canonical.map_values(df, "row_id", "title", catalog).collect()} == dict.fromkeys((1, 2), ids.get(role, 0))


def test_blocks_of_a_long_list_and_unmatched(spark, small, monkeypatch):
    catalog, src = read(spark, small, "role_catalog"), read(spark, small, "sources").limit(120).select("row_id", F.col("position").alias("title"))
    whole = sorted(map(tuple, canonical.map_values(src, "row_id", "title", catalog).collect()))
    monkeypatch.setattr(canonical, "ENTRIES_A_BLOCK", 20)
    mapped = canonical.map_values(src, "row_id", "title", catalog)
    assert sorted(map(tuple, mapped.collect())) == whole
    assert canonical.unmatched(mapped, src, "row_id", "title").count() <= len([x for x in whole if x[1] == 0])
    assert {r.role_id for r in canonical.map_values(src, "row_id", "title", catalog.limit(0)).collect()} == {0}


def test_blocks_know_the_words_of_the_whole_list(spark, monkeypatch):
    catalog = spark.createDataFrame([(1, "Data Engineer", ["Pipeline Engineer"]), (2, "Sommelier", None)], "role_id int, canonical_title string, aliases array<string>")
    titles = spark.createDataFrame([(1, "Data Engineer / Sommelier"), (2, "Data Enginer"), (3, "Sommelier (Lyon)"), (4, "Data Sommelier")], "row_id bigint, title string")
    whole = sorted(map(tuple, canonical.map_values(titles, "row_id", "title", catalog).collect()))
    assert whole == [(1, 0), (2, 1), (3, 2), (4, 0)]
    monkeypatch.setattr(canonical, "ENTRIES_A_BLOCK", 1)
    assert sorted(map(tuple, canonical.map_values(titles, "row_id", "title", catalog).collect())) == whole


# ---------------------------------------------------------------- token ids


TEXTS = ["", None, " ", "Hello world, it's fine.", "a" * 700, "=====" * 60, "<|endoftext|> x", "日本語テキスト 😀😀", "é" * 90, "  \n\n  x\t", "xyzzy" * 120, "I'LL we'll", "\u0000\u0001"]


def test_ids_equal_the_public_library(spark, small):
    from tokenizers import Tokenizer

    path = f"{encoding.TOKENIZERS}/{encoding.VOCABULARY}"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    docs = [r.text for r in read(spark, small, "documents").collect()] + TEXTS
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").withColumn("ids", F.lit("clash"))
    got = {r.doc_id: list(r.ids) for r in encoding.encode_texts(df, "doc_id", "text").collect()}
    for i, t in enumerate(docs):
        assert got[i] == tokenizer.encode(t or "", add_special_tokens=False).ids, i
        assert tokenizer.decode(got[i], skip_special_tokens=False) == (t or "")
    assert encoding.encode_texts(df.limit(0), "doc_id", "text").count() == 0
    back = {r.doc_id: r.text for r in encoding.decode_ids(encoding.encode_texts(df, "doc_id", "text"), "doc_id", "ids").collect()}
    assert back == {i: t or "" for i, t in enumerate(docs)}


def test_long_words_take_no_quadratic_time():
    from tokenizers import Tokenizer

    path = f"{encoding.TOKENIZERS}/{encoding.VOCABULARY}"
    tokenizer, encoder = Tokenizer.from_file(path), encoding.WordEncoder(*encoding.merge_table(path))
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(60_000)), "a" * 50_001, "=" * 30_000, "汉字编码" * 3_000, *("".join(rng.choice("aeiourstln") for _ in range(n)) for n in (90, 120, 399, 401, 700))]
    began = time.time()
    encoder.learn(words)
    assert time.time() - began < 6
    for w in words:
        assert encoder.known[w] == tokenizer.encode(w, add_special_tokens=False).ids
    assert all(encoder._long(w) == encoder.known[w] for w in words[-5:])


# ---------------------------------------------------------------- leaks


def test_leaks_equal_brute_force(spark, small):
    docs, items = read(spark, small, "documents"), read(spark, small, "eval_items")
    passages = {r.item_id: list(r.words) for r in leaks.passages(items).collect()}
    pieces = {}
    for i, w in passages.items():
        for k in range(len(w) - 2):
            pieces.setdefault(tuple(w[k : k + 3]), set()).add(i)
    want = set()
    for r in docs.select("doc_id", leaks.words(F.col("text")).alias("w")).filter("w is not null").collect():
        near = {i for k in range(len(r.w) - 2) for i in pieces.get(tuple(r.w[k : k + 3]), ())}
        want |= {(i, r.doc_id) for i in near if (s := leaks.best_alignment(list(r.w), passages[i]))[0] >= leaks.LEAST and s[1] >= leaks.WINDOW}
    assert {tuple(r) for r in leaks.leaked_items(docs, items).collect()} == want and want


def test_edited_passages_and_shared_sentences(spark):
    passage = "Although Dubamaw promised 369 stamps by Frostmonth, auditor Galivoq found a broken atlas and returned 981 of them to Kelusar."
    shared = "Answer in one sentence and name the record in the passage that supports your answer best."
    items = spark.createDataFrame([(1, f"{passage} Who sealed it? {shared}"), (2, f"Nobody at the quiet harbour of Timoruk ever counted the forty crates twice before winter came. {shared}"), (3, None), (4, "")], "item_id bigint, text string")
    w = passage.split()
    changed = " ".join([*w[:6], "letters", *w[7:]]).upper().replace(" ", "\n")
    dropped = " ".join(w[:9] + w[10:])
    docs = [passage, changed, dropped, " ".join(w[2:14]), " ".join(w[2:12]), shared, None, "", "x " + passage + " y"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    assert {tuple(r) for r in leaks.leaked_items(df, items).collect()} == {(1, 0), (1, 1), (1, 2), (1, 3), (1, 8)}
    assert leaks.leaked_items(df, items.limit(0)).count() == 0 and leaks.leaked_items(df.limit(0), items).count() == 0


def test_shortest_runs_with_single_edits(spark):
    template = "In round {} the {} registry listed {} openings, yet clerk {} struck {} of them because {} had shut its {}."
    fills = [("459", "Difidok", "448", "Rasimul", "857", "Vomumoy", "sluice"), ("302", "Fesodow", "115", "Kelusar", "640", "Tagobiw", "wicket"), ("771", "Galivoq", "926", "Timoruk", "283", "Dubamaw", "granary")]
    items = spark.createDataFrame([(i, template.format(*f)) for i, f in enumerate(fills)], "item_id bigint, text string")
    w = template.format(*fills[0]).split()
    edited = {
        "added": [*w[2:8], "extra", *w[8:14]], "changed": [*w[2:6], "seen", *w[7:14]], "dropped": w[2:8] + w[9:14], "two": [*w[2:6], "seen", *w[7:10], "x", *w[11:15]],
        "thirds": ["x" if k % 3 == 1 else t for k, t in enumerate(w[2:16])], "between": [x for t in w[2:14] for x in (t, "x")], "own word lost": [*w[2:4], "Other", *w[5:14]],
    }
    short = {"eleven": [*w[2:8], "extra", *w[8:13]], "adjacent": [*w[2:7], "x", "x", *w[9:14]]}
    others = {"template": template.format("118", "Nehosiq", "204", "Rubeguw", "391", "Hafazuw", "turnstile").split(), "one own word": template.format("459", "Nehosiq", "204", "Rubeguw", "391", "Hafazuw", "turnstile").split()}
    docs = {**edited, **short, **others}
    df = spark.createDataFrame([(n, " ".join(["before", *t, "after"])) for n, t in enumerate(docs.values())], "doc_id bigint, text string")
    got = {(r.item_id, list(docs)[r.doc_id]) for r in leaks.leaked_items(df, items).collect()}
    assert got == {(0, name) for name in edited}
    passages = {r.item_id: list(r.words) for r in leaks.passages(items).collect()}
    own = leaks.own_words(list(passages.items()))
    told = {(i, name) for name, t in docs.items() for i, p in passages.items() if leaks.carried([x.lower().strip(".,") for x in t], p, own)}
    assert told == got


# ---------------------------------------------------------------- quality


def test_holdout_and_weak_labels():
    model = quality.train([t for t, _ in quality.HOLDOUT] * 3)
    kinds = model.probabilities(np.stack([quality.shape(t) for t, _ in quality.HOLDOUT])).argmax(1)
    assert np.mean(kinds == [k for _, k in quality.HOLDOUT]) >= 0.9


def test_calibration_texts_are_not_trained_on(monkeypatch):
    seen = {}
    fit, calibrate = quality.Boosted.fit, quality.Boosted.calibrate
    monkeypatch.setattr(quality.Boosted, "fit", lambda self, x, y: (seen.update(fit={tuple(r) for r in x}), fit(self, x, y))[1])
    monkeypatch.setattr(quality.Boosted, "calibrate", lambda self, x, y: (seen.update(held={tuple(r) for r in x}, kinds=set(y)), calibrate(self, x, y))[1])
    quality.train([])
    assert seen["fit"] and not seen["fit"] & seen["held"] and seen["kinds"] == set(range(len(quality.KINDS)))


def test_kinds_of_documents(spark, small):
    docs = read(spark, small, "documents")
    out = {r.doc_id: r.kind for r in quality.document_kinds(docs).collect()}
    agreed = total = 0
    for r in docs.collect():
        if r.text and r.text.strip():
            weak = quality.weak_label(r.text)
            if weak >= 0:
                total, agreed = total + 1, agreed + (out[r.doc_id] == quality.KINDS[weak])
        else:
            assert r.doc_id not in out or not re.fullmatch(r"\s*", r.text or "")
    assert agreed >= 0.97 * total
    assert quality.document_kinds(docs.limit(0)).count() == 0


def test_statistics_of_empty_texts(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "One, two.\n\nthe end"), (4, "a " * 100_000)], "doc_id bigint, text string").withColumn("n_words", F.lit("clash"))
    rows = {r.doc_id: tuple(r)[1:] for r in quality.text_statistics(df).collect()}
    assert rows[1] == rows[2] == (0, 0.0, 0.0, 0.0, 0.0)
    assert rows[3] == (4, 3.0, round(2 / 18, 4), 0.5, 0.25) and rows[4][0] == 100_000

"""Quality rules, line dedup, n-gram join and secret scans against brute force and on odd rows."""

import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obsengine.llm import line_dedup, near_join, quality_rules, queries, secrets, shingles
from obsengine.llm.common import components
from obsengine.llm.shingles import word_hashes

WORD = re.compile("[^\x20\x09-\x0d]+")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    triples = list(zip(words, words[1:], words[2:], strict=False))
    seen, covered = Counter(triples), set()
    for i, t in enumerate(triples):
        if seen[t] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)), len(covered), failed,
    )


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_op1_counts_all_documents_and_rejects_the_bad_ones(spark, sf_dir, documents):
    rows = queries.op1_quality_rules(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    assert all(tuple(r[c] for c in BASE) == base_counts(documents[r.doc_id]) for r in rows)
    assert all(not (r.base_failed and r.kept) for r in rows)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [r for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    assert all(r.kept for r in good)


def test_rules_learn_a_conjunction_and_ignore_noise(spark):
    names = quality_rules.STATISTICS
    rows = [(i % 2 * 500, (i // 2) % 2 * 500, 0, i % 7, 0, 0, 4000 + i % 5, int(not (i % 2 and (i // 2) % 2))) for i in range(400)]
    schema = ", ".join(f"{n} bigint" for n in names) + ", quality int"
    learned = quality_rules.learn(spark.createDataFrame(rows, schema))
    assert len(learned.rules) == 1
    assert {c.statistic for c in learned.rules[0].conditions} == set(names[:2])


@pytest.mark.parametrize("labels", [[], [(1, 1), (5, 1)], [(1, 0), (1, 1), (None, 0), (5, 2)]])
def test_quality_rules_on_odd_rows(spark, odd_docs, labels):
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int")
    rows = quality_rules.quality_rules(odd_docs, frame).collect()
    assert len(rows) == odd_docs.count()
    texts = Counter(repr(base_counts(r.text)) for r in odd_docs.collect())
    assert Counter(repr(tuple(r[c] for c in BASE)) for r in rows) == texts
    kept = quality_rules.keep_good(odd_docs, frame)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 6]


def test_text_operators_on_no_rows(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert quality_rules.keep_good(no_docs, labels).count() == 0
    assert line_dedup.dedup_lines(no_docs).count() == 0
    assert near_join.near_join(no_docs).count() == 0
    assert near_join.drop_near_copies(no_docs).count() == 0
    assert secrets.find_secrets(no_docs).count() == 0


@pytest.mark.parametrize("name", ["op4_secret_scans", "op5_line_dedup", "op7_ngram_jaccard_join"])
def test_query_equals_its_sql(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = duck.execute(f"SELECT {', '.join(columns)} FROM ({queries.SQL[name]})").fetchall()
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


# Secrets


def plain_spans(text):
    found = []
    for n, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), n, m.end()))
    return sorted(found)


ODD_TEXTS = [
    None, "", "password", "token=abc secret=token: abcdefgh", "API_KEY = \"abcdefghij\" apikey:x",
    "🎉é AKIAAKIA" + "A1" * 9 + " " + "0a" * 12 + "g" + "ab" * 11,
    "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36 + " sk_live_" + "9" * 20,
    "passwd:" + "z" * 5000, "xoxb-1234567890 eyJabcdefgh.abcdefgh1.abcdefgh2 AIza" + "b" * 35,
    "PassWord='" + "f" * 30 + "' Token:" + "q" * 6,
]


def test_secrets_and_redaction_on_odd_texts(spark):
    from pyspark.sql import functions as F

    rows = [(i // 2 if i else None, t, i) for i, t in enumerate(ODD_TEXTS * 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans int")
    found = secrets.find_secrets(docs).select(
        "row.spans", "spans", secrets.redacted(F.col("_text"), F.col("spans")).alias("clean")
    ).toDF("n", "spans", "clean").collect()
    assert len(found) == len(rows)
    for r in found:
        text = rows[r.n][1] or ""
        spans = plain_spans(text)
        assert [tuple(s) for s in r.spans] == spans
        assert ("<SECRET>" in r.clean) == bool(spans)
        assert not spans or plain_spans(r.clean) == []


@pytest.mark.parametrize(
    ("pattern", "text", "holds"),
    [
        ("abc|xyz[0-9]", "..xyz..", True), ("abc|xyz[0-9]", "..xy..", False),
        ("(foo)?bar+", "ba", False), ("(foo)?bar+", "bar", True), ("(?:ab){2}c", "xababcx", True),
        ("a.c", "zzz", True), ("[kK]ey_id", "KEY_ID".lower(), True),
    ],
)
def test_trigram_queries(pattern, text, holds):
    query = secrets.trigram_query(pattern)
    assert all(any(all(t in text for t in o) for o in clause) for clause in query) == holds


@pytest.mark.parametrize("pattern", ["(foo)?bar+", "(ab){3,}cd", "x(?:yz)+?w", "ab+c{2,}d", "[ab]{2,}c+de", "(a|bc)+def", "k_{1,3}ey"])
def test_trigram_queries_hold_for_every_match(pattern):
    """No string that an expression matches lacks a trigram that its query demands."""
    query = secrets.trigram_query(pattern)
    assert query or pattern == "k_{1,3}ey"

    @settings(max_examples=60, deadline=None)
    @given(st.from_regex(pattern))
    def check(text):
        low = text.lower()
        assert all(any(all(t in low for t in o) for o in clause) for clause in query)

    check()


# Lines


def test_line_dedup_of_ids_that_are_no_numbers(spark):
    """Numbers keep their order; other ids come last, each row a place of its own."""
    line, other = "one two three four", "five six seven"
    rows = [("b", line), ("10", f"{line}\n{other}"), ("9", line), ("a", other), (None, line), ("b", f"{line}\nx y z")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = line_dedup.dedup_lines(docs).select("row.doc_id", "text", "n_exact").collect()
    got = sorted((r.doc_id or "", r.text, r.n_exact) for r in found)
    assert got == sorted([("b", "", 1), ("10", other, 1), ("9", line, 0), ("a", "", 1), ("", "", 1), ("b", "x y z", 1)])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=7), st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=7))
def test_lines_within_one_edit_share_a_variant_and_an_end(a, b):
    def distance(x, y):
        row = list(range(len(y) + 1))
        for i, p in enumerate(x, 1):
            row, last = [i], row
            for j, q in enumerate(y, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (p != q)))
        return row[-1]

    near = distance(a, b) <= 1
    assert line_dedup.within_one(a, b) == near
    if near and a and b:
        ha, hb = word_hashes(a), word_hashes(b)
        assert set(line_dedup.variants(ha)) & set(line_dedup.variants(hb))
        assert set(line_dedup._halves(ha)) & set(line_dedup._halves(hb))


def test_line_dedup_on_odd_rows(spark, odd_docs):
    out = line_dedup.dedup_lines(odd_docs).select("row.*", "text", "n_exact", "n_near")
    assert out.count() == odd_docs.count()
    line = "the quick brown fox jumps over the lazy dog again and again"
    rows = [
        (1, f"{line}\nhi\n{line}"), (2, line.replace("lazy", "idle")), (3, f"x\n{line.upper()}\nx"),
        (4, line + " now"), (5, line.replace("quick ", "")), (6, line.replace("quick", "slow").replace("fox", "cat")),
        (None, line), (7, "hi\nhi"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r[0]: tuple(r)[1:] for r in line_dedup.dedup_lines(docs).select("row.doc_id", "text", "n_exact", "n_near").collect()}
    assert found == {
        1: (f"{line}\nhi", 1, 0), 2: ("", 0, 1), 3: ("x\nx", 1, 0), 4: ("", 0, 1), 5: ("", 0, 1),
        6: (rows[5][1], 0, 0), None: ("", 1, 0), 7: ("hi\nhi", 0, 0),
    }


def test_rows_without_an_id_of_their_own_are_places_of_their_own(spark):
    """Equal lines at other or at the same number, exact and near, under null and repeated ids."""
    long = "the quick brown fox jumps over the lazy dog again and again"
    for key in (None, 7):
        rows = [
            (key, "p q r\nx y z"), (key, "x y z\nu v w"), (key, "x y z\nu v w"), (3, "a b c"),
            (key, f"k l m\n{long}\no n e"), (key, f"t w o\n{long} now\na b c"), (key, None),
        ]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
        out = line_dedup.dedup_lines(docs).select("row.doc_id", "text", "n_lines", "n_exact", "n_near")
        assert sorted(map(tuple, out.collect()), key=repr) == sorted([
            (key, "p q r\nx y z", 2, 0, 0), (key, "u v w", 2, 1, 0), (key, "", 2, 2, 0), (3, "a b c", 1, 0, 0),
            (key, f"k l m\n{long}\no n e", 3, 0, 0), (key, "t w o", 3, 1, 1), (key, None, 0, 0, 0),
        ], key=repr)


# Near copies


def brute_components(texts):
    sets, parent = [], list(range(len(texts)))
    for t in texts:
        w = (t or "").encode().lower().split()
        grams = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())
        sets.append(grams)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [len(s) for s in sets], [root(i) for i in range(len(sets))]


def test_near_join_of_chains_copies_and_common_passages(spark):
    import random

    rng = random.Random(5)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for family in range(12):
        base = [f"f{family}w{rng.randrange(500)}" for _ in range(rng.choice([3, 5, 30, 120]))]
        if family % 3 == 0:
            base += passage
        for _ in range(rng.choice([1, 4, 25])):
            texts.append(" ".join(base))
            base = list(base)
            for _ in range(rng.randrange(3)):
                base[rng.randrange(len(base))] = f"m{rng.randrange(9)}"
    texts += [" ".join(passage)] * 40 + [" ".join([*passage[: 60 - i], f"t{i}"]) for i in range(15)] + ["", None, "a b", "A  B\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sizes, roots = brute_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_join.near_join(docs).collect()}
    assert got == {i: (sizes[i], roots[i]) for i in range(len(texts))}


def test_near_join_on_odd_rows(odd_docs):
    got = Counter(tuple(r) for r in near_join.near_join(odd_docs).collect())
    assert got[(1, 3, 1)] == 2 and got[(None, 3, 1)] == 1 and got[(8, 3, 1)] == 1
    assert got[(2, 0, 2)] == got[(3, 0, 3)] == got[(4, 0, 4)] == 1
    assert {k[2] for k in got if k[0] in (5, 6)} == {5}
    kept = near_join.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert len([r for r in kept.collect() if r.text and r.text.lower().startswith("one")]) == 1
    assert kept.count() == 6


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), *range(100, 160), 999]], "node bigint")
    found = components(nodes, spark.createDataFrame(links, "a bigint, b bigint"))
    assert {r.node: r.root for r in found.collect()} == {n: 0 if n < 41 else 100 if n < 160 else n for n in [*range(41), *range(100, 160), 999]}


def test_keep_good_stores_no_texts_where_ids_are_clear(spark, odd_docs, monkeypatch):
    stored, real = {}, quality_rules.materialize

    def keep(df, name):
        stored[name] = df.columns
        return real(df, name)

    monkeypatch.setattr(quality_rules, "materialize", keep)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    words = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, words), (2, None), (3, "few words"), (4, words + " more")], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in quality_rules.keep_good(docs, labels).collect()) == [1, 4]
    assert not {"row", "text"} & {c for columns in stored.values() for c in columns}
    quality_rules.keep_good(odd_docs, labels).count()  # ids repeat: stored with the rows
    assert "row" in stored["statistics"]


def test_line_tables_are_gone_before_variants(spark, monkeypatch):
    events = []
    real_store, real_drop = line_dedup.materialize, line_dedup.discard
    monkeypatch.setattr(line_dedup, "materialize", lambda df, name: events.append(name) or real_store(df, name))
    monkeypatch.setattr(line_dedup, "discard", lambda *t: events.append(f"discard {len(t)}") or real_drop(*t))
    line = "a b c d e f g h i j k l"
    docs = spark.createDataFrame([(1, line), (2, line + " m"), (3, line)], "doc_id bigint, text string")
    got = {r.row.doc_id: (r.n_exact, r.n_near) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (0, 0), 2: (0, 1), 3: (1, 0)}
    assert events.index("discard 2") < events.index("variants") < events.index("pairs")
    assert events[events.index("pairs") + 1] == "discard 1"


def test_hashing_many_distinct_words_costs_what_hashing_costs():
    """Each word is hashed once and nothing is remembered: texts have more distinct words than a worker can keep."""
    import time

    import xxhash

    found = [b"word%d" % i for i in range(150_000)]

    def seconds(work):
        spent = []
        for _ in range(5):
            start = time.process_time()
            work()
            spent.append(time.process_time() - start)
        return min(spent)

    plain = seconds(lambda: [xxhash.xxh3_64_intdigest(w) for w in found])
    assert seconds(lambda: word_hashes(found)) < 2 * plain
    assert word_hashes(found[:9]).tolist() == [xxhash.xxh3_64_intdigest(w) for w in found[:9]]


def test_shingle_sets_are_sorted_and_distinct():
    text = b" ".join([b"a b c d e f"] * 40) + b" x y z"
    found = shingles.shingle_set(text)
    whole = shingles.combine(word_hashes(text.split()), 5)
    assert found.tolist() == sorted(set(whole.tolist()))
    assert len(shingles.shingle_set(b"a B")) == 1 and len(shingles.shingle_set(None)) == 0


def test_postings_are_shuffled_share_by_share(spark, monkeypatch):
    """Disk holds the shuffle of one share of the tokens at a time, and all shares together are whole."""
    turns, shared = [], near_join._shared

    def seen(postings):
        turns.append({r[0] for r in postings.selectExpr(f"pmod(token, {near_join.PASSES})").distinct().collect()})
        return shared(postings)

    monkeypatch.setattr(near_join, "_shared", seen)
    text = [f"w{i} and then w{i + 1} some w{i * i} of it" for i in range(40)]
    rows = [(i, " ".join(text[i % 5 : i % 5 + 30])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in near_join.near_join(docs).collect()}
    assert sorted(map(list, turns)) == [[k] for k in range(near_join.PASSES)]
    assert found == {i: 0 for i in range(20)}


def test_line_keys_are_hashes_of_words():
    """Lines that differ in one word share a half, and each word counts by its own hash."""
    line = [b"w%d" % i for i in range(12)]
    other = [*line[:8], b"x", *line[9:]]
    a, b = (line_dedup._halves(word_hashes(x)) for x in (line, other))
    assert a[0] == b[0] and a[1] != b[1]
    assert not isinstance(getattr(shingles, "_hashes", None), dict)  # no memory of words, which was slower

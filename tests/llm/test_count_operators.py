"""Token counts, the divergence audit and periodic runs against the library, SQL and brute force."""

import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from obsengine.llm import divergence, periodic_runs, queries, token_counts

# Token counts


@pytest.fixture(scope="module")
def counters():
    path = queries.tokenizer_file("byte_bpe_50k.json")
    return Tokenizer.from_file(path), token_counts.TokenCounter(path)


def library_count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_op11_equals_the_library(spark, sf_dir, documents, counters):
    library, _ = counters
    rows = queries.op11_token_counts(spark, sf_dir).collect()
    assert len(rows) == len(documents)
    for r in rows:
        text = documents[r.doc_id] or ""
        expected = library_count(library, text)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), expected, expected > 1024)


def test_counts_for_every_character(counters):
    library, ours = counters
    for first in range(0, 0x30000, 64):
        for c in (chr(n) for n in range(first, first + 64) if not 0xD800 <= n < 0xE000):
            text = f"a{c}b 1{c}2 {c} {c}{c}c'{c}"
            assert ours.tokens(text) == library_count(library, text), hex(ord(c))


@settings(max_examples=400, deadline=None)
@given(text=st.lists(st.sampled_from([*"ab'sStre 1,.\n\t\r éÉß\xa0\x85Σ日́", "<|endoftext|>", "<|end", "  "]), max_size=25).map("".join))
def test_counts_of_any_text(counters, text):
    library, ours = counters
    assert ours.tokens(text) == library_count(library, text)


def test_counts_stay_right_when_the_memory_is_full(counters, monkeypatch):
    library, _ = counters
    monkeypatch.setattr(token_counts.TokenCounter, "LIMIT", 5)
    ours = token_counts.TokenCounter(queries.tokenizer_file("byte_bpe_50k.json"))
    text = " ".join(f"word{i}, Lorem" for i in range(200)) + "x" * 5000
    assert ours.tokens(text) == library_count(library, text)
    assert len(ours) <= 5


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.TokenCounter(queries.tokenizer_file("word_bpe_49k.json"))


def test_counts_of_odd_rows(odd_docs, no_docs, counters):
    library, _ = counters
    count = token_counts.token_count(queries.tokenizer_file("byte_bpe_50k.json"))
    rows = odd_docs.withColumn("tokens", count("text")).collect()
    assert len(rows) == 10
    assert all(r.tokens == library_count(library, r.text) for r in rows)
    assert no_docs.select(count("text")).count() == 0


# Divergence audit


def audit(df, **options):
    rows = divergence.source_divergence(df, **options).collect()
    assert len({tuple(r)[:4] for r in rows}) == len(rows)
    return sorted(tuple(r) for r in rows)


def in_duckdb(sql, tables):
    connection = duckdb.connect()
    for name, frame in tables.items():
        connection.register(name, frame)
    return sorted(connection.execute(sql).fetchall())


@pytest.mark.parametrize("block", [1, 3, 32])
def test_op12_equals_its_sql(spark, sf_dir, monkeypatch, block):
    """Also when the sources of a language lie in several blocks."""
    monkeypatch.setattr(divergence, "BLOCK", block)
    found = queries.op12_source_divergence(spark, sf_dir)
    expected = in_duckdb(divergence.divergence_sql(), {"documents": spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()})
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert {r[2] for r in expected} == {"pair", "term"}


def test_audit_of_odd_rows(spark):
    texts = ["É éa b!c B", "b b a", None, "", "12 \x7f", "z-z A", "日本 b"]
    rows = [
        (texts[n % 7], [None, "", "en", "de"][n % 4], [None, "s", "t", "", "é", "z" * 40][n % 6], n, n)
        for n in range(400)
    ]
    rows += [("only here", "xx", "lonely", 0, 0)] * 12 + [(None, "none", s, 0, 0) for s in "ab"] * 3
    docs = spark.createDataFrame(rows, "text string, lang string, source string, term int, n int")
    columns = "text, lang, source"
    expected = in_duckdb(divergence.divergence_sql(), {"documents": docs.selectExpr(*columns.split(", ")).toPandas()})
    assert audit(docs) == expected
    assert ("none", "a", "pair", "b", 0, 1) in expected
    assert not [r for r in expected if r[0] == "xx"]  # no other source, and p equals q


def test_audit_merges_equal_cells_and_cuts_ties_by_item(spark):
    """More than ten terms of one value: the first by UTF-8 bytes are listed."""
    words = [f"{c}{d}" for c in "zyéx" for d in "abcdef"]
    rows = [(" ".join(words), "en", "a")] * 10 + [("other", "en", "b")] * 10
    found = audit(spark.createDataFrame(rows, "text string, lang string, source string"))
    terms = [(r[3], r[5]) for r in found if r[:3] == ("en", "a", "term")]
    assert sorted(terms, key=lambda t: t[1]) == [(w, n + 1) for n, w in enumerate(sorted(words, key=str.encode)[:10])]


def test_audit_of_no_rows(no_docs):
    assert audit(no_docs) == []


def test_frequencies_are_exact(spark):
    big = 9_000_000_000_000_000
    row = spark.range(1).select(
        divergence.frequency(F.lit(big), F.lit(3 * big), F.lit(7)).alias("p"),
        divergence.frequency(F.lit(1), F.lit(0), F.lit(0)).alias("none"),
    ).first()
    assert row.p == 1 + 10**9 * (big + 2) // (3 * big + 14)
    assert row.none is None


# Periodic runs


def runs_by_force(words):
    """Stretches of words equal to those q further on, for every q."""
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    numbers = np.array([names[w] for w in words], np.int64)
    found = {}
    for q in range(1, len(numbers) // 2 + 1):
        equal = np.concatenate([[0], (numbers[:-q] == numbers[q:]).astype(np.int8), [0]])
        starts, ends = np.flatnonzero(np.diff(equal) == 1), np.flatnonzero(np.diff(equal) == -1)
        long = ends - starts + q >= max(12, 2 * q)
        for s, e in zip(starts[long].tolist(), ends[long].tolist()):
            found.setdefault((s, e - s + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed_by_force(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone).decode()


def runs_of(texts):
    sizes = np.array([len(t) for t in texts], np.int64)
    found = [[] for _ in texts]
    for text, *run in zip(*(x.tolist() for x in periodic_runs.runs_of(np.array(sum(texts, []), np.int64), sizes))):
        found[text].append(tuple(run))
    return found


PERIODIC = st.builds(
    lambda head, body, times, part, tail: head + (body * times)[: len(body) * times - part] + tail,
    *(st.lists(st.integers(0, 2), max_size=n) for n in (6, 9)), st.integers(1, 9), st.integers(0, 4), st.lists(st.integers(0, 2), max_size=6),
)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(PERIODIC, min_size=1, max_size=4))
def test_runs_are_all_maximal_runs(texts):
    assert runs_of(texts) == [runs_by_force(t) for t in texts]


def test_runs_of_long_texts_in_blocks(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH", 64)
    monkeypatch.setattr(periodic_runs, "CANDIDATES", 50)
    fibonacci = [0]
    for _ in range(10):
        fibonacci = [x for s in fibonacci for x in ((0, 1) if s == 0 else (0,))]
    rng = np.random.default_rng(5)
    for letters in (1, 2, 3, 40):
        text = rng.integers(0, letters, 300).tolist()
        assert runs_of([text[:9], text, text[:70], fibonacci]) == [runs_by_force(t) for t in (text[:9], text, text[:70], fibonacci)]


def test_grammar_levels_shrink():
    symbols = np.append(np.random.default_rng(1).integers(0, 50, 50_000), -1)
    sizes = [len(level.symbols) for level in periodic_runs.recompress(symbols)]
    assert sizes[-1] == 2 or sizes[-1] == 1
    assert sum(sizes) < 8 * len(symbols)  # a quarter of the neighbours is joined, every other level joins blocks


def test_op13_equals_brute_force(spark, sf_dir, documents):
    rows = queries.op13_periodic_runs(spark, sf_dir).collect()
    assert len(rows) == len(documents)
    planted = 0
    for r in rows:
        words = (documents[r.doc_id] or "").encode().split()
        h = zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = runs_by_force(words)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        best = min(((-m, s, q) for s, m, q in runs), default=None)
        expected = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *expected)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed_by_force(words, runs).encode()).hexdigest()
    assert planted > 5


def test_runs_of_odd_rows(spark, odd_docs, no_docs):
    find = periodic_runs.periodic_runs()
    more = spark.createDataFrame([("a b c " * 9,), ("x\x0b" * 12,), ("x x " * 11,)], "text string").select(
        F.lit(9).cast("long").alias("doc_id"), "text", *(F.lit(0).alias(c) for c in odd_docs.columns[2:])
    )
    rows = odd_docs.union(more).withColumn("found", find("text")).collect()
    assert len(rows) == 13
    for r in rows:
        words = (r.text or "").encode().split()
        runs = runs_by_force(words)
        assert r.found.n_words == len(words)
        assert [tuple(x) for x in r.found.runs] == runs
        assert r.found.collapsed == collapsed_by_force(words, runs)
    assert no_docs.select(find("text")).count() == 0

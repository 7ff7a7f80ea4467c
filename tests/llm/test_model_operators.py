"""Neighbour search, the classifier, the language model and the pipeline."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from obsengine.llm import gru, lm_scoring, multi_index, queries, rule_ensemble

# Neighbours


def exact(ids, x, q, k=10):
    d = np.sqrt(((x - x[q]) ** 2).sum(1))
    return [i for i in np.lexsort((ids, d)) if ids[i] != ids[q]][:k], d


def test_op2_recall_and_exact_scores(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    ids, x = frame.vec_id.to_numpy(), np.stack(frame.embedding).astype(float)
    got: dict = {}
    for r in queries.op2_multi_index(spark, sf_dir).collect():
        got.setdefault(r.query_id, []).append(r)
    hits = total = 0
    for q in np.flatnonzero(ids % 100 == 0):
        near, d = exact(ids, x, q)
        rows = sorted(got.pop(ids[q]), key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in rows] == sorted((r.score, r.vec_id) for r in rows)
        assert all(math.isclose(r.score, d[ids == r.vec_id][0], rel_tol=1e-12) for r in rows)
        hits += len({r.vec_id for r in rows} & set(ids[near]))
        total += len(near)
    assert not got and hits >= 0.9 * total


def test_neighbours_of_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "CHUNK", 4)
    nan, inf = float("nan"), float("inf")
    good = [(i, [1.0, 0.0, i / 10]) for i in range(5)] + [(i, [0.0, 2.0, 0.0]) for i in range(10, 30)]
    odd = [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 1.0]), (104, [nan, 1.0, 1.0]),
           (105, [inf, 0.0, 0.0]), (106, [1.0]), (None, [1.0, 1.0, 1.0])]
    docs = spark.createDataFrame(good + odd, "vec_id bigint, embedding array<double>").selectExpr("*", "vec_id AS id", "1 AS v", "2 AS cell")
    out = multi_index.nearest(docs, lambda i: i % 10 == 0, k=3, recall=1.0).collect()
    rows = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in out}
    assert rows == {
        (0, 1): (1, 0.1), (0, 2): (2, 0.2), (0, 3): (3, 0.3),
        **{(10, i): (10 + i, 0.0) for i in (1, 2, 3)}, **{(20, i): (9 + i, 0.0) for i in (1, 2, 3)},
    }
    few = docs.filter("vec_id < 2")
    assert [(r.query_id, r.vec_id) for r in multi_index.nearest(few, lambda i: i % 10 == 0).collect()] == [(0, 1)]
    assert multi_index.nearest(docs.filter("vec_id > 99"), lambda i: i % 10 == 0, k=1).count() == 0


def test_neighbours_of_every_length(spark):
    """Queries of a rare length find the rows of their length; no query is left out."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=2 + (i >= 299) + (i >= 480)).tolist()) for i in range(500)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got: dict = {}
    for r in multi_index.nearest(frame, lambda i: i % 100 == 0, k=5, recall=1.0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert sorted(got) == [0, 100, 200, 300, 400]
    hits = 0
    for q, found in got.items():
        same = [(i, v) for i, v in rows if len(v) == len(rows[q][1])]
        ids, x = np.array([i for i, _ in same]), np.array([v for _, v in same])
        near, d = exact(ids, x, int(np.flatnonzero(ids == q)[0]), 5)
        hits += len({ids[i] for i in near} & {v for v, _ in found.values()})
        assert sorted(found) == [1, 2, 3, 4, 5]
        assert all(math.isclose(s, d[ids == v][0], rel_tol=1e-12) for v, s in found.values())
    assert hits >= 0.9 * 25


def test_cells_are_visited_by_growing_sum():
    rng = np.random.default_rng(0)
    a, b = rng.random(7), rng.random(5)
    order = multi_index.visit(a, b, np.ones(35, int), 35)
    sums = [a[c // 5] + b[c % 5] for c in order]
    assert sorted(order) == list(range(35)) and sums == sorted(sums)


# Classifier


def test_op6_on_held_out_rows(spark, sf_dir, documents):
    rows = queries.op6_rule_ensemble(spark, sf_dir.replace("sf0.001", "sf0.01")).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    right = [r.predicted == labels[r.doc_id] for r in held if r.doc_id in labels]
    assert sum(right) >= 0.95 * len(right)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(i, i % 2) for i in (1, 2, 3, 4, 6, 7, 8)] + [(None, 1), (1, 7)]])
def test_classifier_on_odd_rows(spark, odd_docs, no_docs, labels):
    frame = spark.createDataFrame(labels, "doc_id bigint, quality int")
    rows = rule_ensemble.classify(odd_docs, frame).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 1}) == 1
    assert rule_ensemble.classify(no_docs, frame).count() == 0


def test_ensemble_finds_a_conjunction_and_few_rules():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 100, (3000, 4)).astype(float)
    y = (~((x[:, 0] > 60) & (x[:, 1] > 30))).astype(float)
    paths = rule_ensemble.tree_rules(x, y, trees=10, depth=3, rate=0.3, bins=32, least=6)
    r = np.column_stack([rule_ensemble.covers(x, p) for p in paths]).astype(float)
    weights, intercept = rule_ensemble.lasso_logistic(r, y, 2e-3)
    assert ((r @ weights + intercept > 0) == y).mean() > 0.97
    assert (weights != 0).sum() < 0.7 * len(paths)


def test_compiled_rules_equal_rules_read_row_by_row(spark):
    """The Spark expression of an ensemble against its paths and weights, one row at a time."""
    rng = np.random.default_rng(8)
    names = rule_ensemble.FEATURES
    x = rng.integers(0, 6, (400, len(names))).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3)).astype(int)
    frame = spark.createDataFrame(
        [(i, *row, int(label)) for i, (row, label) in enumerate(zip(x.tolist(), y))],
        ", ".join(["doc_id bigint", *(f"`{n}` double" for n in names), "label int"]),
    )
    ensemble = rule_ensemble.fit(frame, "label")
    assert len(ensemble.rules) > 2
    scores = {r.doc_id: r.score for r in frame.select("doc_id", ensemble.score().alias("score")).collect()}
    for i, row in enumerate(x):
        total = ensemble.intercept
        for path, weight in ensemble.rules:
            total += weight * all(row[j] > t if above else row[j] <= t for j, above, t in path)
        assert math.isclose(scores[i], 1 / (1 + math.exp(-total)), rel_tol=1e-9)


# Language model


def brute_base(texts, folds=10):
    split = {d: (t or "").encode().lower().split() + [None] for d, t in texts.items()}
    held = {d: zlib.crc32(str(d).encode()) % folds == 0 for d in texts}
    c = Counter(itertools.chain.from_iterable(w for d, w in split.items() if not held[d]))
    n, v = sum(c.values()), len(c)
    base = {d: sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w) for d, w in split.items()}
    known = {d: sum(c[x] > 0 for x in w) for d, w in split.items()}
    return {d: (held[d], len(w), known[d], n, base[d]) for d, w in split.items()}


def check_scores(rows, texts):
    expected = brute_base(texts)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        held, n, known, total, base = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isfinite(r.score) and r.score < 0


def test_op9_counts_all_and_beats_the_base(spark, sf_dir, documents, monkeypatch):
    monkeypatch.setattr(lm_scoring, "TABLE_WORDS", 3000)  # so that counts are joined too
    rows = queries.op9_recurrent_lm(spark, sf_dir).collect()
    check_scores(rows, documents)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_training_learns_from_every_token(spark):
    """Short texts, copies and long texts alike; the state of a long text is handed on."""
    sizes = [0, 1, 5, 40, 63, 64, 65, 300, 1000]
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(n)) for i, n in enumerate(sizes * 20)] + ["the same"] * 30 + [None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr("cast(text AS binary) AS _bytes")
    known = lm_scoring._table(lm_scoring._counts(docs))
    table = spark.sparkContext.broadcast(known)
    model, learned = gru.initial(known.words, known.tail_total.astype(np.float64)), 0
    for turn in range(lm_scoring.ROUNDS):
        model, n = lm_scoring._train(docs, table, model, turn)
        learned += n
    assert learned == known.n == sum(len((t or "").split()) + 1 for t in texts)


def test_lanes_hand_states_on():
    rng = np.random.default_rng(5)
    model = gru.initial(rng.integers(1, 9, 2048), np.ones(40))
    docs = [rng.integers(0, 2088, n) for n in (*rng.integers(1, 90, 300), 700, 1, 64, 129)]
    seen = []

    class Reader:
        def learn(self, x, fresh, cls, word, used, h):
            states, last, _ = gru.forward(model, x, fresh, h)
            logs = gru.log_probs(model, states.reshape(-1, gru.HIDDEN), cls.reshape(-1), word.reshape(-1))
            seen.append(logs[used.reshape(-1)])
            return last

    lanes = lm_scoring._Lanes(Reader(), 7)
    for doc in docs:
        lanes.add(doc)
    lanes.finish()
    seen = np.concatenate(seen)
    assert len(seen) == sum(map(len, docs))
    assert math.isclose(seen.sum(), lm_scoring._model_scores(model, docs, 7).sum(), rel_tol=1e-5)


def test_language_model_on_odd_rows(spark, odd_docs, no_docs):
    rows = lm_scoring.lm_scores(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(math.isfinite(r.score) for r in rows)
    blank = [r for r in rows if r.doc_id in (2, 3, 4)]
    assert len({(r.n_tokens, r.base_score, r.score) for r in blank}) == 1
    assert lm_scoring.lm_scores(no_docs).count() == 0
    only_held = odd_docs.filter("doc_id = 8").selectExpr("14L AS doc_id", "text")
    assert zlib.crc32(b"14") % 10 != 0 or lm_scoring.lm_scores(only_held).first().n_known == 0


def test_probabilities_of_all_words_add_up_to_one():
    rng = np.random.default_rng(0)
    counts = rng.integers(1, 50, 128)
    model = gru.initial(counts, np.array([5.0, 0, 9]))
    model = model.unpacked(model.packed() + rng.normal(0, 0.1, len(model.packed())).astype(np.float32))
    h = rng.normal(0, 1, (1, gru.HIDDEN)).astype(np.float32)
    cls = np.array([*np.repeat([0, 1], 64), 2, 3, 4])
    word = np.array([*np.tile(np.arange(64), 2), 0, 0, 0])
    logs = gru.log_probs(model, np.repeat(h, len(cls), 0), cls, word)
    assert math.isclose(np.exp(logs).sum(), 1, rel_tol=1e-4)


def test_gradients_equal_differences():
    rng = np.random.default_rng(3)
    model = gru.initial(rng.integers(1, 9, 64), np.array([4.0, 2.0]))
    model = model.unpacked(model.packed() + rng.normal(0, 0.2, len(model.packed())).astype(np.float32))
    x, cls = rng.integers(0, 66, (5, 3)), rng.integers(0, 3, (5, 3))
    word = np.where(cls == 0, rng.integers(0, 64, (5, 3)), 0)
    fresh, used = rng.random((5, 3)) < 0.2, rng.random((5, 3)) < 0.8
    h = rng.normal(0, 1, (3, gru.HIDDEN)).astype(np.float32)

    def loss(flat):
        m = model.unpacked(flat)
        states, _, _ = gru.forward(m, x, fresh, h)
        rows = used.reshape(-1)
        return -gru.log_probs(m, states.reshape(-1, gru.HIDDEN)[rows], cls.reshape(-1)[rows], word.reshape(-1)[rows]).mean()

    grads, _ = gru.gradients(model, x, fresh, h, cls, word, used)
    flat = np.concatenate([g.reshape(-1) for g in grads])
    direction = rng.normal(0, 1, len(flat)) * (rng.random(len(flat)) < 0.3)
    step = 2e-3
    start = model.packed().astype(np.float64)
    change = (loss(start + step * direction) - loss(start - step * direction)) / (2 * step)
    assert math.isclose(change, float(flat @ direction), rel_tol=0.03)


def test_state_crosses_windows():
    """Scores of a document don't depend on the others or on where windows end."""
    rng = np.random.default_rng(4)
    model = gru.initial(rng.integers(1, 9, 2048), np.ones(40))
    docs = [rng.integers(0, 2088, n) for n in (1, 31, 32, 33, 200)]
    together = lm_scoring._model_scores(model, docs, 7)
    alone = [lm_scoring._model_scores(model, [d], 7)[0] for d in docs]
    assert np.allclose(together, alone, rtol=1e-4)
    x = np.concatenate([[7], docs[4][:-1]])[:, None]
    states, _, _ = gru.forward(model, x, np.eye(200, 1, dtype=bool), np.zeros((1, gru.HIDDEN), np.float32))
    cls, word = lm_scoring._targets(docs[4])
    assert math.isclose(gru.log_probs(model, states[:, 0], cls, word).sum(), alone[4], rel_tol=1e-4)


# Pipeline


def test_pipeline_stages(spark, sf_dir, documents):
    from llm import test_token_operators as tokens

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        seen[name] = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert set(seen["quality_rules"]) < set(documents)
    assert set(seen["line_dedup"]) == set(seen["quality_rules"])
    assert set(seen["ngram_jaccard_join"]) <= set(seen["line_dedup"])
    assert set(seen["secret_scans"]) == set(seen["ngram_jaccard_join"])
    assert docs.filter("n_chars <> length(text)").isEmpty()
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    tokens.check_packed(rows, seen["secret_scans"])


def test_pipeline_on_odd_rows(spark, odd_docs, no_docs, sf_dir):
    for start in (odd_docs, no_docs):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), name)
        assert (docs.count() > 0) == (start is odd_docs)


def test_runs_are_added_like_one_by_one():
    rng = np.random.default_rng(6)
    ids = np.concatenate([rng.integers(0, 40, 90), np.full(30, 3), [41, 41]])
    rows = rng.normal(0, 1, (len(ids), 5)).astype(np.float32)
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[order], prepend=-1))
    out, expected = np.ones((43, 5), np.float32), np.ones((43, 5))
    gru._add_runs(out, ids[order[first]], rows, order, first)
    np.add.at(expected, ids, rows)
    assert np.allclose(out, expected, atol=1e-5)


@pytest.mark.parametrize("size", [0.2, 40.0])
def test_log_probs_of_near_and_far_logits(size):
    """Weights of 40 put logits hundreds apart, where only each row's own largest may be taken off."""
    rng = np.random.default_rng(7)
    model = gru.initial(rng.integers(1, 9, 128), np.array([4.0, 2.0]))
    model = model.unpacked(rng.normal(0, size, len(model.packed())))
    h = rng.uniform(-1, 1, (2000, gru.HIDDEN)).astype(np.float32)
    cls = rng.integers(0, 4, 2000)
    word = np.where(cls < 2, rng.integers(0, 64, 2000), 0)

    def logs(logits):
        largest = logits.max(1, keepdims=True)
        return logits - largest - np.log(np.exp(logits - largest).sum(1, keepdims=True))

    wide = h.astype(np.float64)
    expected = logs(wide @ model.classes + model.class_bias)[np.arange(2000), cls]
    for k in (0, 1):
        at = np.flatnonzero(cls == k)
        expected[at] += logs(wide[at] @ model.words[k] + model.word_bias[k])[np.arange(len(at)), word[at]]
    assert (gru._shift(model.classes, model.class_bias, 1.0) is None) == (size > 1)
    assert np.allclose(gru.log_probs(model, h, cls, word), expected, rtol=1e-4, atol=1e-3)


def test_table_finds_what_it_holds():
    rng = np.random.default_rng(8)
    near = (rng.integers(-1 << 62, 1 << 62) >> 40 << 40) + np.arange(9) * 64  # the same highest bits
    token = np.unique(np.concatenate([rng.integers(-1 << 63, (1 << 63) - 1, 3000), near, [-1 << 63, (1 << 63) - 1]]))
    none = np.zeros(40, np.int64)
    known = lm_scoring.Table(token[::2], np.arange(len(token[::2])), token[::2] & 63, none, none, none, 0, 0)
    there, count, inputs = known.look_up(token)
    place = {t: i for i, t in enumerate(token[::2].tolist())}
    assert there.tolist() == [t in place for t in token.tolist()]
    assert count.tolist() == [place.get(t, 0) for t in token.tolist()]
    assert inputs[there].tolist() == (token[::2] & 63).tolist()


def test_learning_takes_no_array_of_doubles():
    """The step on all weights stays in the weights' own precision, and in place."""
    rng = np.random.default_rng(9)
    model = gru.initial(rng.integers(1, 9, 2048), np.ones(40))
    trainer, weights = gru.Trainer(model, gru.WINDOW * 4), model.packed()
    x, y = rng.integers(0, 2088, (2, 2 * gru.WINDOW, 4))
    cls, word = lm_scoring._targets(y)
    h, used = np.zeros((4, gru.HIDDEN), np.float32), np.ones(x.shape, bool)
    before = [p.ctypes.data for p in trainer.model.parts()]
    h = trainer.learn(x, ~used, cls, word, used, h)
    assert trainer.updates == 2 and h.dtype == np.float32
    assert [p.ctypes.data for p in trainer.model.parts()] == before
    assert all(p.dtype == np.float32 and p.base is trainer._flat for p in trainer.model.parts())
    assert not np.array_equal(trainer.model.packed(), weights)
    assert np.array_equal(model.packed(), weights)


def test_texts_are_cut_up_for_counts_and_once_more(spark, tmp_path, monkeypatch):
    """Training and scoring read the numbers of the tokens, not the text."""
    calls, cut = str(tmp_path / "calls"), lm_scoring.tokens

    def noted(text):
        with open(calls, "ab") as out:
            out.write(b".")
        return cut(text)

    monkeypatch.setattr(lm_scoring, "tokens", noted)
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(60)], "doc_id bigint, text string")
    rows = lm_scoring.lm_scores(docs).collect()
    trained = sum(not r.held_out for r in rows)
    assert 0 < trained < 60
    with open(calls, "rb") as out:
        assert len(out.read()) == 60 + trained


def test_coded_documents_train_like_their_texts(spark):
    texts = [" ".join(f"w{(i * j) % 97}" for j in range(i % 150)) for i in range(200)] + [None, "", "w1 W1\tunseen"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    docs = docs.selectExpr("doc_id", "cast(text AS binary) AS _bytes")
    known = lm_scoring._table(lm_scoring._counts(docs.filter("doc_id < 202")))
    table = spark.sparkContext.broadcast(known)
    coded = lm_scoring._coded(docs, table)
    assert "_bytes" not in coded.columns
    unseen = 0
    for r in coded.collect():
        text = (texts[r.doc_id] or "").encode()
        found = lm_scoring.tokens(text)
        there, count, inputs = known.look_up(found)
        assert np.array_equal(np.frombuffer(r.inputs, np.uint16), inputs)
        assert r.turn == lm_scoring.xxhash.xxh3_64_intdigest(text) % lm_scoring.ROUNDS
        assert r.rest == found[~there].tolist()
        assert (r.n_tokens, r.n_known) == (len(found), np.count_nonzero(count))
        unseen += len(r.rest)
    assert unseen == 1
    model = gru.initial(known.words, known.tail_total.astype(np.float64))
    (one, n), (other, m) = (lm_scoring._train(d, table, model, 1) for d in (docs, coded.select("turn", "inputs")))
    assert n == m > 0 and np.array_equal(one.packed(), other.packed())


def test_tokens_are_hashes_with_the_class_of_the_last_byte():
    texts = [b"", b" ", b"a", b" A\tb.\v\x1c \x85\n", "\u00e9t\u00e9 \u00a0 2,".encode(), b"x" * 300 + b"\r\f" + b"\xff\x00"]
    for text in texts:
        expected = []
        for word in text.lower().split():
            code = (lm_scoring.xxhash.xxh3_64_intdigest(word) & lm_scoring._MASK) << 6 | lm_scoring._tail_of(word[-1])
            expected.append(code - (1 << 63))
        assert lm_scoring.tokens(text).tolist() == [*expected, lm_scoring.END]
    assert lm_scoring.tokens(None).tolist() == [lm_scoring.END]


def test_a_token_beyond_the_table_is_not_searched_for():
    """As few places are read for a token after the last of the table as for others."""

    class Counted(np.ndarray):
        reads = 0

        def __getitem__(self, at):
            Counted.reads += 1
            return np.asarray(self)[at]

    none = np.zeros(40, np.int64)
    token = np.arange(-40_000, 0) << 40
    known = lm_scoring.Table(token, np.ones(len(token), np.int64), token & 63, none, none, none, 0, 0)
    known.token = known.token.view(Counted)
    there, count, inputs = known.look_up(np.array([(1 << 63) - 64, token[-1], token[0] - 64, token[7], token[-1] + 64]))
    assert there.tolist() == [False, True, False, True, False] and count.tolist() == [0, 1, 0, 1, 0]
    assert (inputs[~there] == lm_scoring.SHORTLIST).all()
    assert Counted.reads < 100

"""Language-model scoring of whole documents: a smoothed unigram base and a recurrent model.

All training documents are counted. The recurrent model is trained where the
documents are: each task improves the common weights on its own documents and
the weights are averaged, round by round. Each document falls to one round by
the hash of its text, and that round learns from all its tokens, states carried
from segment to segment; so every token of every training document is learned
from once. Scoring reads every token of every document, states carried from
window to window. Texts are cut up once for the counts and once for all the
rest, which reads the numbers of their tokens.
"""

from __future__ import annotations

import heapq
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.llm import gru
from obsengine.llm.common import slices
from obsengine.session import materialize

#: Words that the model predicts one by one.
SHORTLIST = 2048
#: Words whose counts every task has at hand; counts of rarer words are joined.
TABLE_WORDS = 1 << 19
SCORED = 5_000  # documents scored together: many, so that one long text leaves few lanes idle
CODED = 500  # documents looked up together: few, so that their tokens stay near the processor
ROUNDS, SEGMENT, LANES = 2, 2 * gru.WINDOW, 128

# A token is a 58-bit hash of the word and, in the low 6 bits, its tail class.
_TAILS = 40
_MASK = (1 << 58) - 1
#: Highest bits of a token by which a table finds it.
_HEAD_BITS = 20


def _tail_of(last: int) -> int:
    """Tail class of a word by its last byte: letters, some marks, digits, parts of other letters."""
    if 97 <= last <= 122:
        return last - 97
    if last >= 0x80:
        return 32 + (last >> 3 & 7)
    return {46: 26, 44: 27, 33: 28, 124: 29}.get(last, 30 if 48 <= last <= 57 else 31)


#: Tail class by the last byte, and what marks white space.
_SPACE = 255
_KINDS = bytes(_SPACE if byte in b" \t\n\v\f\r" else _tail_of(byte) for byte in range(256))
#: The end of a document; no word has its code, which would be that of an empty word.
END = (xxhash.xxh3_64_intdigest(b"") & _MASK) << 6 | 31
END -= 1 << 63


def tokens(text: bytes | None) -> np.ndarray:
    """Tokens of a text, A-Z in lower case, with the end token last."""
    text = text.lower() if text else b""
    found = text.split()
    out = np.empty(len(found) + 1, np.int64)
    codes = out[:-1].view(np.uint64)
    # Hashing anew is faster than asking a dictionary of many words.
    codes[:] = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    codes <<= np.uint64(6)  # which leaves the bits of the mask
    kinds = np.frombuffer(text.translate(_KINDS) + bytes([_SPACE]), np.uint8)
    space = kinds == _SPACE
    codes |= kinds[np.flatnonzero(space[1:] > space[:-1])]  # at the last byte of each word
    codes ^= np.uint64(1 << 63)
    out[-1] = END
    return out


def _counts(docs: DataFrame) -> DataFrame:
    """(token, c) over all training documents; each batch is added up before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tokens(text) for text in batch.column(0).to_pylist()]
            if found:
                token, c = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_pydict({"token": token, "c": c.astype(np.int64)})

    return docs.select("_bytes").mapInArrow(count, "token bigint, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Table:
    """What every task knows: counts of frequent words, the shortlist, totals per tail class."""

    token: np.ndarray  # sorted
    count: np.ndarray
    input: np.ndarray  # number in the shortlist, or SHORTLIST + tail class
    tail_total: np.ndarray
    tail_words: np.ndarray
    words: np.ndarray  # counts of the shortlist
    n: int
    v: int

    def __post_init__(self):
        # Where tokens with the same highest bits begin; they are hashes, so few share these.
        edges = np.arange(1 << _HEAD_BITS, dtype=np.int64) - (1 << _HEAD_BITS - 1) << 64 - _HEAD_BITS
        self._starts = np.append(np.searchsorted(self.token, edges), len(self.token)).astype(np.int32)
        self._found = np.asarray(self.count, np.int64) << 16 | self.input  # side by side, for one look

    def look_up(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether a token is in the table, its count, and its input number."""
        tail = SHORTLIST + (found & 63)
        if not len(self.token):
            return np.zeros(len(found), bool), np.zeros(len(found), np.int64), tail
        head = (found >> 64 - _HEAD_BITS) + (1 << _HEAD_BITS - 1)
        at, end = self._starts[head], self._starts[head + 1]
        at[at == len(self.token)] -= 1  # beyond the last token: this differs, and none comes after it
        there = self.token[at] == found
        left = np.flatnonzero(~there & (at + 1 < end))
        while len(left):
            at[left] += 1
            there[left] = self.token[at[left]] == found[left]
            left = left[~there[left] & (at[left] + 1 < end[left])]
        both = self._found[at]
        return there, np.where(there, both >> 16, 0), np.where(there, both & 0xFFFF, tail)

    def end(self) -> int:
        """Input number of the end token."""
        return int(self.look_up(np.array([END]))[2][0])


def _table(counts: DataFrame) -> Table:
    """At most ``TABLE_WORDS`` words reach the driver: those above the frequency at which so many are left."""
    step = F.floor(F.log2("c") * 16)
    steps = counts.groupBy(step.alias("s")).count().orderBy(F.desc("s")).collect()  # at most 16 * 64 rows
    least, total = 1 << 20, 0
    for row in steps:
        total += row["count"]
        if total > TABLE_WORDS:
            break
        least = row["s"]
    rows = counts.filter(step >= least).toPandas().sort_values(["c", "token"], ascending=[False, True])
    token, count = rows["token"].to_numpy(np.int64), rows["c"].to_numpy(np.int64)
    number = SHORTLIST + (token & 63)
    short = token[:SHORTLIST] if END in token[:SHORTLIST] else np.append(token[: SHORTLIST - 1], END)
    place = {t: i for i, t in enumerate(short.tolist())}
    chosen = np.isin(token, short)
    number[chosen] = [place[t] for t in token[chosen].tolist()]
    words = np.zeros(SHORTLIST, np.int64)
    words[number[chosen]] = count[chosen]
    totals, kinds = np.zeros(_TAILS, np.int64), np.zeros(_TAILS, np.int64)
    n = v = 0
    tail = F.col("token").bitwiseAND(F.lit(63))
    for row in counts.groupBy(tail.alias("k")).agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        totals[row["k"]], kinds[row["k"]] = row["c"], row["v"]
        n, v = n + row["c"], v + row["v"]
    np.subtract.at(totals, token[chosen] & 63, count[chosen])
    np.subtract.at(kinds, token[chosen] & 63, 1)
    order = np.argsort(token)
    return Table(token[order], count[order], number[order], totals, kinds, words, n, v)


#: Class and word in it by input number.
_CLASS_OF = np.append(np.arange(SHORTLIST) // gru.CLASS_SIZE, SHORTLIST // gru.CLASS_SIZE + np.arange(64)).astype(np.uint16)
_WORD_OF = np.append(np.arange(SHORTLIST) % gru.CLASS_SIZE, np.zeros(64)).astype(np.uint16)


def _targets(inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class and word in it of input numbers."""
    return _CLASS_OF.take(inputs), _WORD_OF.take(inputs)


def _coded(docs: DataFrame, table) -> DataFrame:
    """The documents without their text, but what training and scoring need of it, so that it is cut up once.

    ``inputs`` are the input numbers of its tokens, two bytes each; ``turn`` the
    training round it falls to; ``n_known`` and ``base`` what the table settles
    of the base, ``inner`` the same of words in their tail classes; ``rest`` the
    tokens whose counts are still to be joined.
    """
    names = [name for name in docs.columns if name != "_bytes"]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = table.value
        base_n = np.log10(known.n + 0.1 * (known.v + 1))
        tail_n = np.zeros(SHORTLIST + 64)  # by input
        tail_n[SHORTLIST : SHORTLIST + _TAILS] = np.log10(known.tail_total + 0.1 * (known.tail_words + 1))
        number = TaskContext.get().partitionId() << 40
        for batch in slices(batches, CODED):
            texts = batch.column(len(names)).to_pylist()
            found = [tokens(text) for text in texts]
            sizes = np.array([len(f) for f in found], np.int64)
            source = np.repeat(np.arange(len(found)), sizes)
            flat = np.concatenate(found) if found else np.empty(0, np.int64)
            there, count, inputs = known.look_up(flat)
            missing = np.flatnonzero(~there)
            logs = np.log10(count + 0.1)
            logs[missing] = 0
            inner = logs - tail_n.take(inputs)
            inner[inputs < SHORTLIST] = 0
            ends = np.cumsum(sizes)
            kept = inputs.astype(np.uint16)
            offsets = np.append(0, np.cumsum(np.bincount(source[missing], minlength=len(found))))
            made = {
                "row": number + np.arange(len(found)),
                "turn": [xxhash.xxh3_64_intdigest(text or b"") % ROUNDS for text in texts],
                "n_tokens": sizes,
                "n_known": np.bincount(source[count > 0], minlength=len(found)),
                "base": np.bincount(source, logs - base_n, len(found)),
                "inner": np.bincount(source, inner, len(found)),
                "inputs": [kept[a:b].tobytes() for a, b in zip(ends - sizes, ends, strict=True)],
                "rest": pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat[missing])),
            }
            columns = [pa.array(made["inputs"], pa.binary()) if name == "inputs" else pa.array(v) for name, v in made.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], *columns], [*names, *made])
            number += len(found)

    schema = [f"`{name}` {kind}" for name, kind in docs.dtypes if name != "_bytes"]
    schema += ["row bigint, turn bigint, n_tokens bigint, n_known bigint, base double, inner double"]
    return docs.select(*names, "_bytes").mapInArrow(code, ", ".join([*schema, "inputs binary, rest array<bigint>"]))


class _Lanes:
    """Documents one after the other in lanes, which a trainer reads side by side with their states."""

    def __init__(self, trainer: gru.Trainer, end: int):
        self._trainer, self._end = trainer, end
        # Per lane: targets that wait, and how many of the first document's are read.
        self._waiting: list[deque[np.ndarray]] = [deque() for _ in range(LANES)]
        self._read_of = [0] * LANES
        self._sizes = [(0, lane) for lane in range(LANES)]
        self._states = np.zeros((LANES, gru.HIDDEN), np.float32)
        self._last = np.full(LANES, end, np.uint16)  # target before the next segment

    def add(self, targets: np.ndarray) -> None:
        """A document goes to the shortest lane; lanes are read while all have a whole segment."""
        size, lane = self._sizes[0]
        self._waiting[lane].append(targets)
        heapq.heapreplace(self._sizes, (size + len(targets), lane))
        while self._sizes[0][0] >= SEGMENT:
            self._read()

    def finish(self) -> None:
        while any(self._waiting):
            self._read()

    def _read(self) -> None:
        """Learn from the next segment of every lane that has something waiting."""
        live = [lane for lane, parts in enumerate(self._waiting) if parts]
        by_lane = np.full((len(live), SEGMENT), self._end, np.uint16)
        opens, filled = [], np.empty(len(live), np.int64)
        for i, lane in enumerate(live):
            parts, done, at = self._waiting[lane], self._read_of[lane], 0
            while parts and at < SEGMENT:
                targets = parts[0]
                if not done:
                    opens.append(i * SEGMENT + at)
                n = min(len(targets) - done, SEGMENT - at)
                by_lane[i, at : at + n] = targets[done : done + n]
                done, at = done + n, at + n
                if done == len(targets):
                    parts.popleft()
                    done = 0
            self._read_of[lane], filled[i] = done, at
        y = np.ascontiguousarray(by_lane.T)
        fresh = np.zeros(by_lane.size, bool)
        fresh[opens] = True
        fresh = np.ascontiguousarray(fresh.reshape(by_lane.shape).T)
        used = np.arange(SEGMENT)[:, None] < filled
        x = np.concatenate([self._last[live][None], y[:-1]])
        self._last[live] = y[-1]
        x[fresh] = self._end
        x[~used] = self._end
        cls, word = _targets(y)
        self._states[live] = self._trainer.learn(x, fresh, cls, word, used, self._states[live])
        self._sizes = [(max(0, size - SEGMENT), lane) for size, lane in self._sizes]
        heapq.heapify(self._sizes)


def _train(docs: DataFrame, table, model: gru.Model, turn: int) -> tuple[gru.Model, int]:
    """One round over the training documents that fall to it: the mean of the tasks' weights by the
    tokens they learned from, and the number of these. Documents that are not yet coded are so first."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    coded = docs if "inputs" in docs.columns else _coded(docs, table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = gru.Trainer(shared.value.unpacked(shared.value.packed()), gru.WINDOW * LANES)
        lanes = _Lanes(trainer, table.value.end())
        for batch in batches:
            for inputs in batch.column(0).to_pylist():
                lanes.add(np.frombuffer(inputs, np.uint16))
        lanes.finish()
        if trainer.learned:
            weights = trainer.model.packed().astype(np.float64) * trainer.learned
            yield pa.RecordBatch.from_pydict(
                {"slot": [TaskContext.get().partitionId() % 256], "n": [trainer.learned], "weights": [weights.tobytes()]}
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = None, 0
        for batch in batches:
            for count, weights in zip(*(batch.column(i).to_pylist() for i in (1, 2)), strict=True):
                one = np.frombuffer(weights)
                total, n = one if total is None else total + one, n + count
        if total is not None:
            yield pa.RecordBatch.from_pydict({"slot": [TaskContext.get().partitionId() % 8], "n": [n], "weights": [total.tobytes()]})

    # Two levels of sums over weights of a fixed size; eight rows reach the driver.
    schema = "slot bigint, n bigint, weights binary"
    sums = coded.filter(F.col("turn") == turn).select("inputs").mapInArrow(run, schema)
    for parts in (64, 8):
        sums = sums.repartition(parts, "slot").mapInArrow(add, schema)
    rows = sums.collect()
    if not rows:
        return model, 0
    n = sum(r["n"] for r in rows)
    return model.unpacked(sum(np.frombuffer(r["weights"]) for r in rows) / n), n


def _lanes(lengths: list[int], most: int = 256) -> list[list[int]]:
    """Documents dealt to lanes of about equal length, the longest first."""
    lanes: list[list[int]] = [[] for _ in range(max(1, min(most, len(lengths))))]
    heap = [(0, i) for i in range(len(lanes))]
    for doc in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        total, lane = heapq.heappop(heap)
        lanes[lane].append(doc)
        heapq.heappush(heap, (total + lengths[doc], lane))
    return lanes


def _model_scores(model: gru.Model, docs: list[np.ndarray], end: int) -> np.ndarray:
    """Natural log-probability of the classes and shortlist words of each document's inputs."""
    out = np.zeros(len(docs))
    if not docs:
        return out
    lanes = _lanes([len(d) for d in docs])
    lanes.sort(key=lambda lane: -sum(len(docs[d]) for d in lane))  # those that end first come last
    dealt = [d for lane in lanes for d in lane]
    sizes = np.array([len(docs[d]) for d in dealt], np.int64)
    flow = np.concatenate([docs[d] for d in dealt]).astype(np.uint16)
    owner = np.repeat(np.array(dealt, np.int32), sizes)
    opens = np.zeros(len(flow), bool)
    opens[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    lengths = np.array([sum(len(docs[d]) for d in lane) for lane in lanes], np.int64)
    begins = np.cumsum(lengths) - lengths
    h, heads = np.zeros((len(lanes), gru.HIDDEN), np.float32), gru.Heads(model, 1.0)
    # Lanes are read window by window, so memory besides the documents is bounded by lanes x window.
    for start in range(0, int(lengths[0]), gru.WINDOW):
        live = int(np.count_nonzero(lengths > start))
        step = start + np.arange(gru.WINDOW)[:, None]
        real = (step < lengths[:live]).reshape(-1)
        at = np.minimum(begins[:live] + step, len(flow) - 1)
        fresh = opens[at]
        x = np.where(fresh, end, flow[at - 1])
        states, h, _ = gru.forward(model, x, fresh, h[:live])
        at = at.reshape(-1)[real]
        cls, word = _targets(flow[at])
        scores = gru.log_probs(model, states.reshape(-1, gru.HIDDEN)[real], cls, word, heads)
        out += np.bincount(owner[at], scores, len(docs))
    return out


def _scored(coded: DataFrame, table, model) -> DataFrame:
    """Coded documents with the model's log10 probability, but for the counts that are still to be joined."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, end = model.value, table.value.end()
        for batch in slices(batches, SCORED):
            docs = [np.frombuffer(inputs, np.uint16) for inputs in batch.column(0).to_pylist()]
            scores = _model_scores(weights, docs, end) / np.log(10) + batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(scores), *batch.columns[2:]], ["model", *names])

    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base"]
    kinds = dict(coded.dtypes)
    schema = ", ".join(["model double", *(f"{name} {kinds[name]}" for name in names)])
    return coded.select("inputs", "inner", *names).mapInArrow(score, schema)


def lm_scores(docs: DataFrame, *, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Rows whose id as text has a CRC-32 divisible by ``folds`` are held out of
    all counts and training. Both scores are log10 probabilities of all tokens,
    the end included; a null text is the end alone. Null ids are trained on;
    repeated rows are counted and scored each. Without training rows both
    models have seen nothing and every token is unknown. The log-probability of
    a word outside the shortlist is that of its tail class and of the word in
    it, smoothed like the base; so the probabilities of all words add up to 1.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    base = docs.select("doc_id", held.alias("held_out"), F.col("text").cast("binary").alias("_bytes"))
    counts = materialize(_counts(base.filter(~F.col("held_out"))), "counts")
    known = _table(counts)
    context = docs.sparkSession.sparkContext
    table = context.broadcast(known)
    model = gru.initial(known.words, known.tail_total.astype(np.float64))
    coded = materialize(_coded(base, table), "coded")
    for turn in range(ROUNDS):
        model, _ = _train(coded.filter(~F.col("held_out")), table, model, turn)
    parts = materialize(_scored(coded, table, context.broadcast(model)), "parts")
    rare = coded.select("row", F.explode("rest").alias("token")).join(counts, "token", "left")
    c = F.coalesce("c", F.lit(0))
    added = rare.groupBy("row").agg(
        F.sum(F.log10(c + F.lit(0.1))).alias("logs"), F.count_if(c > 0).alias("more")
    )
    full = parts.join(added, "row", "left")
    logs, more = F.coalesce("logs", F.lit(0.0)), F.coalesce("more", F.lit(0))
    return full.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more).alias("n_known"),
        F.lit(known.n).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"), (F.col("model") + logs).alias("score"),
    )

"""Language-model scores: a hashed maximum-entropy model beside a smoothed unigram score.

The model predicts each token from the two before it. Features are hashed: the
previous token (1-gram), the previous two (2-gram), the one before the previous
(skip), and a constant. The softmax is factored: a token hashes to one of
``CLASSES`` classes and one of ``MEMBERS`` members of its class, the model gives
P(class | features) * P(member | features, class), and within a member the
tokens share the probability by their smoothed counts. All probabilities of a
context sum to one, a share of every member being left for unseen tokens.

Training is distributed: in every round each task starts from the shared
weights, makes gradient steps over its documents in numpy, and what it changed is
averaged, weighted by tokens, shard by shard of the feature rows and over fixed
numbers of tasks at a time. The number of feature rows grows with the training
text: a shard of ``FEATURES`` rows for each ``SHARD_BYTES``.

Counts cover all training tokens. The vocabulary grows with the corpus, so it is
never broadcast: one pass turns the documents into blocks, each with its own
sorted list of distinct tokens; the lists are dealt by token hash into shards
that add up the counts; each block gets the counts of its own tokens back and is
scored by itself. A frequent token counts once per block there, so no shard is
hot, and a block is bounded in size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import ship_package, staged, text_of
from dimflow.llm.hashing import mix, slices, word_hashes

FEATURES = 1 << 14  # feature rows in a shard of the weights
SHARD_BYTES = 2 << 30  # training text for each shard
CLASSES = MEMBERS = 16
ROUNDS = 2
STEP = 4096  # positions in a gradient step
RATE = 0.5
BLOCK_TOKENS = 4_000_000
SHARD_ENTRIES = 500_000
FAN_IN = 64
END = np.uint64(0x5851F42D4C957F2D)  # the token that ends every text

DOC_ROW = "block long, id {id}, held_out boolean, shard long, tokens binary, counts binary"


def training_row(id_col: str) -> Column:
    """Documents whose crc32(id as text) mod 5 is not 1; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 != 1


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text ended by ``END``, and where each text starts (with the end)."""
    hashes, first = word_hashes(texts)
    return np.insert(hashes, first[1:], END), first + np.arange(len(first))


def _contexts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Feature indices (one row per position); positions before the text count as the end token."""
    before = np.concatenate([[END], hashes])[:len(hashes)]
    before[first[:-1]] = END
    skipped = np.concatenate([[END, END], hashes])[:len(hashes)]
    skipped[first[:-1]] = END
    second = first[:-1][np.diff(first) > 1] + 1
    skipped[second] = END
    return np.stack([np.zeros(len(hashes), np.uint64), mix(before + np.uint64(1)), mix(skipped + np.uint64(2)),
                     mix(before * np.uint64(3) + skipped)], 1)


def _columns(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(hashes ^ END)
    return (h % np.uint64(CLASSES)).astype(np.int64), (h // np.uint64(CLASSES) % np.uint64(MEMBERS)).astype(np.int64)


def _softmax(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    z = weights.take(rows[:, 0], 0)
    for j in range(1, rows.shape[1]):
        z += weights.take(rows[:, j], 0)
    z -= z.max(1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(1, keepdims=True)
    return z


def _factors(contexts: np.ndarray, classes: np.ndarray, features: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Rows, of so many, of the class weights and of the member weights that each position adds up."""
    by_class = mix(contexts + (classes.astype(np.uint64)[:, None] + np.uint64(1)) * END)
    return (contexts % np.uint64(features)).astype(np.int64), (by_class % np.uint64(features)).astype(np.int64)


def gradient_steps(weights: list[np.ndarray], hashes: np.ndarray, first: np.ndarray, rate: float) -> None:
    """Steps over all positions, ``STEP`` at a time, in place."""
    contexts = _contexts(hashes, first)
    classes, members = _columns(hashes)
    place = np.zeros(len(weights[0]), np.int64)  # where a touched feature row's slopes are added up
    for at in range(0, len(hashes), STEP):
        cut = slice(at, at + STEP)
        for w, rows, goal in zip(weights, _factors(contexts[cut], classes[cut], len(weights[0])),
                                 (classes[cut], members[cut])):
            error = _softmax(w, rows)
            error[np.arange(len(goal)), goal] -= 1
            flat, width = rows.ravel(), error.shape[1]
            place[flat] = 1
            touched = np.flatnonzero(place)
            place[touched] = np.arange(len(touched))
            cells = (place[flat] * width).reshape(rows.shape)[:, :, None] + np.arange(width)
            slopes = np.broadcast_to(error[:, None, :], cells.shape)
            slope = np.bincount(cells.ravel(), slopes.ravel(), len(touched) * width).reshape(-1, width)
            times = np.bincount(place[flat], minlength=len(touched))[:, None]
            place[touched] = 0
            # A row that many positions touch moves by the root of their number, not by all of their slopes.
            w[touched] -= (rate * slope / np.sqrt(times * (STEP / 64))).astype(w.dtype)


def log_probability(weights: list[np.ndarray], hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """log10 P(class) * P(member | class) of every position."""
    contexts = _contexts(hashes, first)
    classes, members = _columns(hashes)
    out = np.empty(len(hashes))
    for at in range(0, len(hashes), STEP):
        cut = slice(at, at + STEP)
        by_class, by_member = _factors(contexts[cut], classes[cut], len(weights[0]))
        here = np.arange(len(by_class))
        out[cut] = np.log10(np.maximum(_softmax(weights[0], by_class)[here, classes[cut]].astype(np.float64)
                                       * _softmax(weights[1], by_member)[here, members[cut]], 1e-300))
    return out


def feature_shards(size: int) -> int:
    """Shards of feature rows for ``size`` bytes of training text."""
    return max(1, -(-size // SHARD_BYTES))


def _unpack(packed: bytes) -> list[np.ndarray]:
    """Class and member weights (one row per feature) from shards, each with its class rows before its member rows."""
    flat = np.frombuffer(packed, np.float32).reshape(-1, FEATURES * (CLASSES + MEMBERS))
    return [flat[:, :FEATURES * CLASSES].reshape(-1, CLASSES).copy(),
            flat[:, FEATURES * CLASSES:].reshape(-1, MEMBERS).copy()]


def train(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, rate: float = RATE,
          shards: int | None = None) -> bytes:
    """The weights (float32, ``shards`` shards) after ``rounds`` rounds, each over its share of the documents."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(text_of(text_col).alias("text"))
    if shards is None:
        shards = feature_shards(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    weights = bytes(4 * FEATURES * (CLASSES + MEMBERS) * shards)
    for i in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, rate=rate / (1 + i)) -> Iterator[pa.RecordBatch]:
            own, seen = _unpack(shared.value), 0
            for batch in batches:
                for part in slices(batch, 0):
                    hashes, first = token_hashes(part.column(0))
                    gradient_steps(own, hashes, first, rate)
                    seen += len(hashes)
            if seen:
                before = np.frombuffer(shared.value, np.float32).reshape(shards, -1)
                for shard in range(shards):
                    cut = slice(shard * FEATURES, (shard + 1) * FEATURES)
                    change = np.concatenate([w[cut].ravel() for w in own]) - before[shard]
                    change = change.reshape(-1, CLASSES)  # CLASSES and MEMBERS are equal
                    touched = np.flatnonzero(change.any(1)).astype(np.uint16)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([shard], pa.int64()), pa.array([TaskContext.get().partitionId()], pa.int64()),
                         pa.array([float(seen)]), pa.array([touched.tobytes()], pa.binary()),
                         pa.array([change[touched].tobytes()], pa.binary())],
                        names=["shard", "task", "tokens", "rows", "changes"])

        def average(group: pa.Table) -> pa.Table:
            shares = group.column("tokens").to_pylist()
            total = np.zeros((2 * FEATURES, CLASSES))
            for share, at, changes in zip(shares, group.column("rows"), group.column("changes")):
                total[np.frombuffer(at.as_py(), np.uint16)] += share * np.frombuffer(
                    changes.as_py(), np.float32).reshape(-1, CLASSES)
            total = (total / sum(shares)).astype(np.float32)
            touched = np.flatnonzero(total.any(1)).astype(np.uint16)
            return pa.table({"shard": group.column("shard")[:1], "task": group.column("task")[:1],
                             "tokens": [float(sum(shares))], "rows": pa.array([touched.tobytes()], pa.binary()),
                             "changes": pa.array([total[touched].tobytes()], pa.binary())})

        schema = "shard long, task long, tokens double, rows binary, changes binary"
        result = rows.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == i).mapInArrow(run, schema)
        for _ in range(3):  # FAN_IN at a time
            result = (result.withColumn("task", F.floor(F.col("task") / FAN_IN)).groupBy("shard", "task")
                      .applyInArrow(average, schema))
        result = result.withColumn("task", F.lit(0).cast("long")).groupBy("shard", "task").applyInArrow(average, schema)
        flat = np.frombuffer(weights, np.float32).reshape(shards, -1, CLASSES).copy()
        for r in result.select("shard", "rows", "changes").toLocalIterator():  # a shard at a time
            flat[r["shard"], np.frombuffer(r["rows"], np.uint16)] += np.frombuffer(
                r["changes"], np.float32).reshape(-1, CLASSES)
        weights = flat.tobytes()
    return weights


def _blocks(docs: DataFrame, id_col: str, text_col: str, shards: int) -> DataFrame:
    """Documents as token numbers within their block, and the block's distinct tokens with their training counts.

    Both kinds of rows come from one task and are written together, so a block is
    whole whichever attempt of the task succeeds. ``shard`` is null in rows of
    documents; rows of tokens hold the block's tokens of one shard, ascending.
    """
    rows = docs.select(F.col(id_col).alias("id"), (~training_row(id_col)).alias("held_out"),
                       text_of(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def flush(block: int, ids: list, held: list, parts: list, sizes: list) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate(parts)
        tokens, numbers = np.unique(hashes, return_inverse=True)
        numbers = numbers.astype(np.uint32)
        edges = np.concatenate([[0], np.cumsum(sizes)])
        training = np.repeat(~np.array(held, bool), sizes)
        counts = np.bincount(numbers[training], minlength=len(tokens)).astype(np.uint32)
        n = len(sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * n, pa.int64()), pa.concat_arrays(ids), pa.array(held, pa.bool_()),
             pa.nulls(n, pa.int64()),
             pa.array([numbers[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
             pa.nulls(n, pa.binary())], names=["block", "id", "held_out", "shard", "tokens", "counts"])
        shard = (tokens >> np.uint64(11)) % np.uint64(shards)
        used = np.unique(shard)
        picks = [np.flatnonzero(shard == s) for s in used]
        m = len(used)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * m, pa.int64()), pa.nulls(m, ids[0].type), pa.nulls(m, pa.bool_()),
             pa.array(used.astype(np.int64)), pa.array([tokens[p].tobytes() for p in picks], pa.binary()),
             pa.array([counts[p].tobytes() for p in picks], pa.binary())],
            names=["block", "id", "held_out", "shard", "tokens", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        ids, held, parts, sizes = [], [], [], []
        for batch in batches:
            for part in slices(batch, 2):
                hashes, first = token_hashes(part.column(2))
                ids.append(part.column(0))
                held += part.column(1).to_pylist()
                parts.append(hashes)
                sizes += np.diff(first).tolist()
                if sum(map(len, parts)) >= BLOCK_TOKENS:
                    yield from flush((TaskContext.get().partitionId() << 24) + number, ids, held, parts, sizes)
                    number += 1
                    ids, held, parts, sizes = [], [], [], []
        if sizes:
            yield from flush((TaskContext.get().partitionId() << 24) + number, ids, held, parts, sizes)

    return rows.mapInArrow(run, DOC_ROW.format(id=id_type))


def _shard_totals(entries: DataFrame) -> DataFrame:
    """The rows of tokens again, with ``totals`` for their counts in all blocks, and statistics of each shard."""
    def total(group: pa.Table) -> pa.Table:
        parts = [np.frombuffer(t.as_py(), np.uint64) for t in group.column("tokens")]
        counts = np.concatenate([np.frombuffer(c.as_py(), np.uint32) for c in group.column("counts")])
        tokens, numbers = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(numbers, counts, len(tokens)).astype(np.int64)
        edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        classes, members = _columns(tokens)
        bucket = classes * MEMBERS + members
        known = np.bincount(bucket, totals > 0, CLASSES * MEMBERS).astype(np.int64).tolist()
        summed = np.bincount(bucket, totals, CLASSES * MEMBERS).astype(np.int64).tolist()
        first = [True] + [False] * (len(parts) - 1)
        return pa.table({
            "block": group.column("block"), "tokens": group.column("tokens"),
            "totals": pa.array([totals[numbers[a:b]].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
            "known": pa.array([known if f else None for f in first], pa.list_(pa.int64())),
            "summed": pa.array([summed if f else None for f in first], pa.list_(pa.int64()))})

    return entries.select("shard", "block", "tokens", "counts").groupBy("shard").applyInArrow(
        total, "block long, tokens binary, totals binary, known array<long>, summed array<long>")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Scores are log10 probabilities of the whole text, its end included. A null
    text is the empty text: one token, the end. With no training document all
    counts are 0 and the model keeps its equal weights. Repeated rows and null ids
    keep their rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    length = F.octet_length(text_of(text_col))
    size, training = docs.agg(F.sum(length), F.sum(F.when(training_row(id_col), length))).first()
    size = size or 0
    weights = train(docs.where(training_row(id_col)), text_col, rounds, shards=feature_shards(training or 0))
    shards = max(1, int(size // 40 // SHARD_ENTRIES))  # a block has a distinct token for some 40 bytes of text
    table = staged(_blocks(docs, id_col, text_col, shards), "lm_blocks")
    totals = staged(_shard_totals(table.where("shard is not null")), "lm_totals")
    sums = {r["pos"]: (r["known"], r["summed"]) for r in
            totals.where("known is not null").select(F.posexplode(F.arrays_zip("known", "summed")))
            .groupBy("pos").agg(F.sum("col.known").alias("known"), F.sum("col.summed").alias("summed")).collect()}
    n_buckets = CLASSES * MEMBERS
    known = np.array([sums.get(i, (0, 0))[0] for i in range(n_buckets)], np.float64)
    summed = np.array([sums.get(i, (0, 0))[1] for i in range(n_buckets)], np.float64)
    shared = spark.sparkContext.broadcast((weights, known, summed))
    id_type = table.schema["id"].dataType.simpleString()

    def run(doc_rows: pa.Table, token_rows: pa.Table) -> pa.Table:
        packed, known, summed = shared.value
        weights = _unpack(packed)
        tokens = np.concatenate([np.frombuffer(t.as_py(), np.uint64) for t in token_rows.column("tokens")])
        counts = np.concatenate([np.frombuffer(t.as_py(), np.int64) for t in token_rows.column("totals")])
        order = np.argsort(tokens)  # a token's number in the block is its place among them
        tokens, counts = tokens[order], counts[order]
        total, distinct = int(summed.sum()), known.sum()
        base = np.log10((counts + 0.5) / (total + 0.5 * (distinct + 1)))
        classes, members = _columns(tokens)
        bucket = classes * MEMBERS + members
        inside = np.log10((counts + 0.5) / (summed[bucket] + 0.5 * (known[bucket] + 1)))
        numbers = [np.frombuffer(t.as_py(), np.uint32) for t in doc_rows.column("tokens")]
        sizes = [len(x) for x in numbers]
        out = {"n_known": [], "base_score": [], "score": []}
        at = 0
        while at < len(numbers):  # some documents at a time
            to, held = at, 0
            while to < len(numbers) and (to == at or held + sizes[to] <= 500_000):
                held += sizes[to]
                to += 1
            joined = np.concatenate(numbers[at:to]).astype(np.int64)
            first = np.concatenate([[0], np.cumsum(sizes[at:to])])
            model = log_probability(weights, tokens[joined], first) + inside[joined]
            for name, values in (("n_known", (counts[joined] > 0).astype(np.int64)), ("base_score", base[joined]),
                                 ("score", model)):
                out[name] += np.add.reduceat(values, first[:-1]).tolist()
            at = to
        return pa.table({"id": doc_rows.column("id"), "held_out": doc_rows.column("held_out"),
                         "n_tokens": pa.array(sizes, pa.int64()), "n_known": pa.array(out["n_known"], pa.int64()),
                         "train_tokens": pa.array([total] * len(sizes), pa.int64()),
                         "base_score": pa.array(out["base_score"], pa.float64()),
                         "score": pa.array(out["score"], pa.float64())})

    by_block = table.where("shard is null").select("block", "id", "held_out", "tokens").groupBy("block")
    return by_block.cogroup(totals.select("block", "tokens", "totals").groupBy("block")).applyInArrow(
        run, f"id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")

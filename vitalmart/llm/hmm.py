"""Language-model scores from a hidden Markov model over word classes."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, flat, record_batch, stored, text_rows

END = b""  # no word is empty
BLOCK_BYTES = 4 << 20
FREQUENT = 4096     # a token with at least 1/FREQUENT of all training tokens is a class of its own
ENDINGS = 256       # the others fall into this many classes by their last three bytes
_CLASS_BITS = 13    # hold FREQUENT + ENDINGS
PIECE = 512         # training sequences are cut after this many tokens; scoring never cuts
PADDED = 200_000    # tokens, padding included, of one batch of sequences

_BLOCK = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                    ("sizes", pa.list_(pa.int32())), ("tokens", pa.list_(pa.binary())), ("counts", pa.list_(pa.int32())),
                    ("sequence", pa.binary())])
_BLOCK_SQL = ("block bigint, doc_ids array<bigint>, held array<boolean>, sizes array<int>, tokens array<binary>, "
              "counts array<int>, sequence binary")
_CODED = pa.schema([("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())),
                    ("known", pa.list_(pa.int32())), ("base", pa.list_(pa.float64())), ("within", pa.list_(pa.float64())),
                    ("classes", pa.list_(pa.int16()))])
_CODED_SQL = ("doc_ids array<bigint>, held array<boolean>, sizes array<int>, known array<int>, base array<double>, "
              "within array<double>, classes array<smallint>")


def _packed(sequence: np.ndarray, distinct: int) -> bytes:
    """Token numbers of a block in two bytes where they fit, else four, compressed: this is what a block
    writes, moves and reads again, besides its dictionary."""
    width = 2 if distinct <= 1 << 16 else 4
    return bytes([width]) + pa.compress(sequence.astype(f"<u{width}").tobytes(), codec="zstd", asbytes=True)


def _unpacked(packed: bytes, length: int) -> np.ndarray:
    width = packed[0]
    return np.frombuffer(pa.decompress(packed[1:], length * width, codec="zstd"), f"<u{width}").astype(np.int32)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents coded against a dictionary of their block; counts are of training documents."""
    from pyspark import TaskContext

    task = TaskContext.get().partitionId() << 32
    for number, batch in enumerate(chunks(batches, BLOCK_BYTES)):
        ids: dict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        found = [[*t.as_py().lower().split(), END] for t in batch.column("text")]
        sizes = np.fromiter(map(len, found), dtype=np.int32, count=len(found))
        sequence = np.fromiter(map(ids.__getitem__, flat(found)), dtype=np.int32, count=int(sizes.sum()))
        held = np.array(batch.column("held_out").to_pylist(), dtype=bool)
        counts = np.bincount(sequence[np.repeat(~held, sizes)], minlength=len(ids)).astype(np.int32)
        yield record_batch(_BLOCK, [[task + number], [batch.column("doc_id").to_pylist()], [held], [sizes], [list(ids)], [counts],
                                   [_packed(sequence, len(ids))]])


def _class_column(token: Column) -> Column:
    """Class of a token without one of its own."""
    return F.lit(FREQUENT) + F.pmod(F.xxhash64(F.substring(token, -3, 3)), F.lit(ENDINGS))


class Model:
    """start (S), move (S x S) and emit (class x S) probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def draw(cls, states: int, classes: np.ndarray, seed: int = 1) -> Model:
        """Sticky transitions and emissions scattered around the class shares."""
        scatter = np.exp(np.random.default_rng(seed).normal(0, 1, (len(classes), states)))
        emit = classes[:, None] * scatter
        stay = 0.9 if states > 1 else 1.0
        move = np.full((states, states), (1 - stay) / max(1, states - 1))
        np.fill_diagonal(move, stay)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    def fitted(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, classes: np.ndarray, prior: float = 100.0) -> Model:
        """The M-step; ``prior`` pseudo-tokens in proportion to the class shares keep every class possible."""
        emit = emit + prior * classes[:, None]
        move = move + 0.1
        start = start + 0.1
        return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _grouped(sequences: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Sequences of like length together: (numbers, step x sequence grid longest first, active sequences per step)."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    begin = 0
    while begin < len(order):
        longest = len(sequences[order[begin]])
        part = order[begin:begin + max(1, PADDED // longest)]
        sizes = np.array([len(sequences[i]) for i in part])
        grid = np.zeros((longest, len(part)), dtype=np.int64)
        for k, i in enumerate(part):
            grid[:sizes[k], k] = sequences[i]
        yield part, grid, np.searchsorted(-sizes, -np.arange(longest), side="left")
        begin += len(part)


def log_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each whole sequence by the scaled forward recursion."""
    out = np.zeros(len(sequences))
    for part, grid, active in _grouped(sequences):
        total = np.zeros(len(part))
        alpha = np.broadcast_to(model.start, (len(part), len(model.start)))
        for t, n in enumerate(active):
            a = (alpha[:n] if t == 0 else alpha[:n] @ model.move) * model.emit[grid[t, :n]]
            scale = a.sum(axis=1)
            alpha = a / scale[:, None]
            total[:n] += np.log(scale)
        out[part] = total
    return out


def expectations(model: Model, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, transitions and emissions of the sequences, and their log-likelihood."""
    states = len(model.start)
    start, move, emit, logs = np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.shape), 0.0
    for part, grid, active in _grouped(sequences):
        steps = len(active)
        alpha = np.zeros((steps, len(part), states))
        scales = np.ones((steps, len(part)))
        for t, n in enumerate(active):
            a = (model.start if t == 0 else alpha[t - 1, :n] @ model.move) * model.emit[grid[t, :n]]
            scale = a.sum(axis=1)
            np.divide(a, scale[:, None], out=alpha[t, :n])
            scales[t, :n] = scale
        logs += float(np.log(scales).sum())
        beta = np.ones((len(part), states))
        for t in range(steps - 1, 0, -1):
            n = active[t]
            ahead = model.emit[grid[t, :n]] * beta[:n] / scales[t, :n, None]
            alpha[t, :n] *= beta[:n]
            move += alpha[t - 1, :n].T @ ahead
            beta[:n] = ahead @ model.move.T
        alpha[0] *= beta
        start += alpha[0].sum(axis=0)
        used = np.arange(len(part)) < active[:, None]
        flat_grid, flat_alpha = grid[used], alpha[used]
        for s in range(states):
            emit[:, s] += np.bincount(flat_grid, weights=flat_alpha[:, s], minlength=len(emit))
    return start, move * model.move, emit, logs


def _code(train: int, distinct: int, totals: np.ndarray, kinds: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the corpus counts of their dictionary -> class sequences and per-document sums."""
    floor = np.log10(train + distinct + 1)
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(name)[row].values  # noqa: E731, B023
            placed, found = get("placed").to_numpy(), get("found").to_numpy()
            places = placed >> _CLASS_BITS
            counts, classes = np.zeros(len(places), dtype=np.int64), np.zeros(len(places), dtype=np.int64)
            counts[places], classes[places] = found, placed & ((1 << _CLASS_BITS) - 1)
            sizes = get("sizes").to_numpy().astype(np.int64)
            sequence = _unpacked(batch.column("sequence")[row].as_py(), int(sizes.sum()))
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            base = np.log10(counts + 1.0) - floor
            # a class of its own is the token; the others share their class by add-one counts, with one part for the unseen
            within = np.where(classes < FREQUENT, 0.0, np.log10(counts + 1.0) - np.log10(totals[classes] + kinds[classes] + 1.0))
            sums = [np.add.reduceat(x[sequence], begins) for x in ((counts > 0).astype(np.int32), base, within)]
            yield record_batch(_CODED, [[get("doc_ids")], [get("held")], [sizes.astype(np.int32)], *([x] for x in sums),
                                        [classes[sequence].astype(np.int16)]])


def _sequences(batch: pa.RecordBatch, row: int) -> list[np.ndarray]:
    get = lambda name: batch.column(name)[row].values.to_numpy(zero_copy_only=False)
    return np.split(get("classes"), np.cumsum(get("sizes").astype(np.int64))[:-1])


def _expect(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    states, sums = len(model.start), None
    for batch in batches:
        for row in range(batch.num_rows):
            held = batch.column("held")[row].values.to_pylist()
            pieces = [s[i:i + PIECE] for s, h in zip(_sequences(batch, row), held) if not h for i in range(0, len(s), PIECE)]
            if pieces:
                found = expectations(model, pieces)
                sums = found if sums is None else tuple(a + b for a, b in zip(sums, found))
    if sums is not None:
        start, move, emit, logs = sums
        whole = np.concatenate([start, move.ravel(), [logs], emit.ravel()])
        used = np.flatnonzero(whole)
        yield record_batch(pa.schema([("at", pa.int32()), ("v", pa.float64())]), [used.astype(np.int32), whole[used]])


def _scores(model: Model, train: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda name: batch.column(name)[row].values  # noqa: E731, B023
            score = log_likelihoods(model, _sequences(batch, row)) / np.log(10) + get("within").to_numpy()
            yield record_batch(schema, [get("doc_ids"), get("held"), get("sizes").cast(pa.int64()), get("known").cast(pa.int64()),
                                        np.full(len(score), train), get("base"), score])


def held_out_column(id_col: str, parts: int = 7, kept: int = 2) -> Column:
    """crc32 of the id as text leaves ``kept``; rows without an id are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % parts == kept, F.lit(True))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None,
          states: int = 6, rounds: int = 4) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words of the text (A-Z in lower case) and one end. base_score is the add-one
    unigram log10 probability from the training documents' counts. score is the log10
    probability under a hidden Markov model: latent states emit word classes, a class emits its
    words by add-one counts. Frequent tokens are classes of their own, so there are at most
    FREQUENT + ENDINGS classes whatever the vocabulary; counts cover all training tokens.

    Baum-Welch runs over all training documents: each task sums its expected counts, these are
    summed across partitions. There, documents are cut into PIECE tokens; the score's
    scaled forward recursion runs over the whole text and is exact. Documents are coded in
    blocks: only a block's distinct tokens are shuffled to meet their counts, so a frequent word
    is one row per block.

    NULL and word-less texts are the end alone. Unseen tokens have count 0 in both. Repeated rows
    stay and count as often. Without training documents all counts are 0. Empty in, empty out.
    """
    held_out = held_out_column(id_col) if held_out is None else held_out
    rows = text_rows(docs, id_col, text_col, held_out.alias("held_out")).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    blocks = stored(rows.mapInArrow(_blocks, _BLOCK_SQL), "blocks")
    entries = blocks.select("block", F.posexplode(F.arrays_zip("tokens", "counts")).alias("place", "e")).select(
        "block", "place", F.col("e.tokens").alias("token"), F.col("e.counts").alias("n"))
    vocabulary = stored(entries.where("n > 0").groupBy("token").agg(F.sum("n").alias("c")), "vocabulary")
    train, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # at most FREQUENT rows: each holds that share of the training tokens
    top = vocabulary.where(F.col("c") * FREQUENT >= train).orderBy(F.desc("c"), "token").collect()
    own = docs.sparkSession.createDataFrame([(bytes(r.token), i) for i, r in enumerate(top[:FREQUENT])], "token binary, own int")
    classed = vocabulary.join(F.broadcast(own), "token", "left").withColumn("class", F.coalesce("own", _class_column(F.col("token"))))
    totals, kinds = np.zeros(FREQUENT + ENDINGS), np.zeros(FREQUENT + ENDINGS)
    for r in classed.groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        totals[r["class"]], kinds[r["class"]] = r["c"], r["n"]

    # two arrays of plain numbers, filled in the same order, take less than half the room of one of structs
    placed = F.shiftleft(F.col("place").cast("bigint"), _CLASS_BITS).bitwiseOR(F.coalesce("class", _class_column(F.col("token"))).cast("bigint"))
    looked = entries.select("block", "place", "token").join(classed.select("token", "c", "class"), "token", "left").select(
        "block", placed.alias("placed"), F.coalesce("c", F.lit(0)).cast("bigint").alias("found")).groupBy("block").agg(
        F.collect_list("placed").alias("placed"), F.collect_list("found").alias("found"))
    coded = stored(blocks.select("block", "doc_ids", "held", "sizes", "sequence").join(looked, "block").mapInArrow(
        partial(_code, train, distinct, totals, kinds), _CODED_SQL), "coded")

    shares = totals + np.where(np.arange(len(totals)) < len(top), 0, 1)
    shares[len(top):FREQUENT] = 0  # unused classes of their own
    shares = shares / shares.sum()
    model = Model.draw(states, shares)
    for _ in range(rounds):
        sums = coded.select("held", "sizes", "classes").mapInArrow(partial(_expect, model), "at int, v double")
        found = sums.groupBy("at").agg(F.sum("v").alias("v")).toArrow()  # model-sized
        whole = np.zeros(states + states * states + 1 + shares.size * states)
        whole[found["at"].to_numpy()] = found["v"].to_numpy()
        begin = states + states * states
        model = model.fitted(whole[:states], whole[states:begin].reshape(states, states),
                             whole[begin + 1:].reshape(-1, states), shares)
    return coded.mapInArrow(partial(_scores, model, train), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
                                                             "train_tokens bigint, base_score double, score double")

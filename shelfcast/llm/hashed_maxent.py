"""Language-model scores: a hashed maximum-entropy model with class-factored softmax.

``P(token | history) = P(class | history) * P(token | class)``.  The first factor is a softmax
whose features are n-grams and skips of the history: the last word, the last two together, the
word before the last and the one before that, each hashed to a row of weights, one weight a
class.  The second factor is a softmax over the class's words whose biases have a closed form,
their training counts.  Words with equal neighbours share a class: the signs of the summed hash
vectors of a word's neighbours, against the average of the corpus.  Words met once in training
form one class with the unknown word, whose share follows from how many words were met once and
twice; so probabilities of all known words and the unknown one add up to 1.

Texts become *chunks*: rows of token numbers with the chunk's own distinct words.  One exchange
by word adds up counts and neighbours and decides classes, one takes them back to the chunks.
Training is one pass in rounds: tasks start from the round's weights, take AdaGrad steps over
their chunks, and the changes are averaged per row of weights over the tasks that touched it, in
a tree of bounded groups.  Weights have a size that parameters bound (``BUCKETS`` rows); counts
and classes of words grow with the corpus and are never gathered in one place.

Defined results: a null text counts as empty and has one token, the end; documents with a null id
are never learned from; repeated rows have a result each; texts of any length are cut into pieces
of bounded size, whose history goes on across the cut; without training tokens the unknown word
has probability 1 and scores are 0.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.durable import settle
from shelfcast.llm.arrow import batch_of
from shelfcast.llm.scratch import discard

#: Tokens of a chunk; bytes of a text that are cut into words at once.
CHUNK_TOKENS, SLICE_BYTES = 1 << 21, 1 << 24
#: Bits of a class, rows of weights, training rounds, tokens of a gradient step, first step size.
CLASS_BITS, BUCKET_BITS, ROUNDS, BATCH, STEP = 5, 16, 3, 4_096, 0.2
#: Rows of weights in a message, messages added up in one group.
BLOCK_ROWS, FAN_IN = 2_048, 64
#: Rows of weights changed at once; rows of a group that are added up beside other groups (sums of
#: up to seven rows are made one by one, longer ones by NumPy's own rule).
UPDATE_ROWS, SMALL_GROUP = 512, 8
#: Added to every count of the base score.
SMOOTH = 0.1

KNOWN, RARE, BUCKETS = 1 << CLASS_BITS, 1 << CLASS_BITS, 1 << BUCKET_BITS
CLASSES = KNOWN + 1

SPACE = re.compile(rb"[\x20\x09-\x0d]")
END, START = b" ", 0x9E3779B9  # no word holds a space

#: Odd multipliers of the history's words in the features.
MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1], np.uint32)

CHUNKS = (
    "chunk long, ids array<long>, uids array<long>, learns array<boolean>, lengths array<int>, "
    "carry array<long>, tokens binary, upper binary, lower binary, sides array<long>, learned long"
)
WORDS = "hash long, chunk long, place int, n int, side long"
READY = (
    "chunk long, ids array<long>, uids array<long>, learns array<boolean>, lengths array<int>, carry array<long>, "
    "tokens binary, upper binary, counts binary, classes binary, distinct long, once long, twice long, mass array<long>"
)
CHANGES = "member long, block int, total binary, touched binary"
SCORES = "uid long, doc_id long, learns boolean, n_tokens long, n_known long, base double, score double"


def pack(tokens: np.ndarray) -> bytes:
    """Token numbers, compressed byte plane by byte plane."""
    planes = tokens.astype("<u4").view(np.uint8).reshape(-1, 4).T[:3]
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(data: bytes, number: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 3 * number, "zstd"), np.uint8).reshape(3, -1)
    out = np.zeros((planes.shape[1], 4), np.uint8)
    out[:, :3] = planes.T
    return out.view("<u4").ravel().astype(np.int64)


def halves(hashes: np.ndarray) -> tuple[bytes, bytes]:
    """Upper and lower 32 bits; features need the upper ones only."""
    return (hashes >> np.uint64(32)).astype("<u4").tobytes(), hashes.astype("<u4").tobytes()


def joined(row: dict) -> np.ndarray:
    upper, lower = (np.frombuffer(row[c], "<u4").astype(np.uint64) for c in ("upper", "lower"))
    return upper << np.uint64(32) | lower


class _Numbers(dict):
    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def word_slices(data: bytes) -> Iterator[list[bytes]]:
    """The words of a lower-cased text, slice by slice; no word is cut."""
    low = 0
    while low < len(data):
        found = SPACE.search(data, low + SLICE_BYTES) if low + SLICE_BYTES < len(data) else None
        high = found.start() if found else len(data)
        yield data[low:high].split()
        low = high


def neighbour_signs(hashes: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """For each class bit, the sum of the signs of a token's neighbours in its piece."""
    first = np.cumsum(lengths) - lengths
    first = first[lengths > 0]
    out = []
    for bit in range(CLASS_BITS):
        sign = 1 - 2 * ((hashes >> np.uint64(40 + bit)) & np.uint64(1)).astype(np.int8)
        total = np.zeros(len(sign), np.int8)
        total[1:] = sign[:-1]
        total[first] = 0
        after = np.zeros(len(sign), np.int8)
        after[:-1] = sign[1:]
        after[first[1:] - 1] = 0
        out.append(total + after)
    return out


class Chunker:
    """Collects pieces of documents and gives a chunk whenever one is full."""

    def __init__(self, partition: int):
        self.partition, self.made = partition, 0
        self.carry = [START] * 3
        self.clear()

    def clear(self) -> None:
        self.words, self.parts, self.size = _Numbers(), [], 0
        self.ids, self.uids, self.learns, self.lengths = [], [], [], []
        self.first_carry = self.carry

    def add(self, doc_id, uid: int, learn: bool, data: bytes) -> Iterator[tuple]:
        import xxhash

        self.carry = [START] * 3
        if not self.size:
            self.first_carry = self.carry
        ended, slices = False, word_slices(data)
        while not ended:
            words = next(slices, None)
            if words is None:
                words, ended = [END], True
            for low in range(0, len(words), CHUNK_TOKENS):
                part = words[low : low + CHUNK_TOKENS]
                for start in self._fitting(part):
                    here = part[start : start + CHUNK_TOKENS - self.size]
                    if not here:
                        continue
                    if not self.uids or self.uids[-1] != uid:
                        for held, value in zip((self.ids, self.uids, self.learns, self.lengths), (doc_id, uid, learn, 0)):
                            held.append(value)
                    self.parts.append(np.fromiter(map(self.words.__getitem__, here), np.int32, len(here)))
                    self.lengths[-1] += len(here)
                    self.size += len(here)
                    last = [xxhash.xxh64_intdigest(w) >> 32 for w in here[-3:]]
                    self.carry = (self.carry + last)[-3:]
                    if self.size >= CHUNK_TOKENS:
                        yield self.chunk()

    def _fitting(self, part: list) -> Iterator[int]:
        start = 0
        while start < len(part):
            room = CHUNK_TOKENS - self.size
            yield start
            start += room

    def chunk(self) -> tuple:
        import xxhash

        tokens = np.concatenate(self.parts)
        number = len(self.words)
        order = np.argsort(-np.bincount(tokens, minlength=number), kind="stable")
        rank = np.empty(number, np.int32)
        rank[order] = np.arange(number, dtype=np.int32)
        tokens = rank[tokens]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, number)[order]
        lengths, learns = np.array(self.lengths), np.array(self.learns)
        signs = neighbour_signs(hashes[tokens], lengths)
        learn = np.repeat(learns, lengths)
        sides = [int(s[learn].sum(dtype=np.int64)) for s in signs]
        row = (
            self.partition << 33 | self.made, self.ids, self.uids, self.learns, self.lengths,
            self.first_carry, pack(tokens), *halves(hashes), sides, int(learn.sum()),
        )
        self.made += 1
        self.clear()
        return row


def build_chunks(docs: DataFrame, id_col: str, text_col: str, learns: Column) -> DataFrame:
    """``CHUNKS`` of all documents, written once."""
    source = docs.select(
        F.col(id_col).cast("long").alias("id"), F.monotonically_increasing_id().alias("uid"),
        F.coalesce(learns, F.lit(False)).alias("learn"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunker = Chunker(TaskContext.get().partitionId())
        for batch in batches:
            keys = [batch.column(c).to_pylist() for c in ("id", "uid", "learn")]
            for doc_id, uid, learn, data in zip(*keys, batch.column("data")):
                for row in chunker.add(doc_id, uid, learn, data.as_py().lower()):
                    yield batch_of(CHUNKS, [row])
        if chunker.size:
            yield batch_of(CHUNKS, [chunker.chunk()])

    return settle(source.mapInArrow(run, CHUNKS), "maxent-chunks")


def distinct_words(chunks: DataFrame, average: list[float]) -> DataFrame:
    """``WORDS``: the distinct words of each chunk with training count and neighbours.

    ``side`` packs, for each class bit, the neighbours' signs less what the average gives, in
    twelve bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes, lengths = joined(row), np.array(row["lengths"])
                tokens = unpack(row["tokens"], int(lengths.sum()))
                learn = np.repeat(np.array(row["learns"]), lengths)
                mine, number = tokens[learn], len(hashes)
                counts = np.bincount(mine, minlength=number)
                side = np.zeros(number, np.int64)
                for bit, sign in enumerate(neighbour_signs(hashes[tokens], lengths)):
                    total = np.bincount(mine, weights=sign[learn], minlength=number)
                    gap = np.clip(np.round(total - counts * average[bit]), -2047, 2047)
                    side |= (gap.astype(np.int64) + 2048) << (12 * bit)
                columns = [
                    hashes.view(np.int64), np.full(number, row["chunk"]), np.arange(number, dtype=np.int32),
                    counts.astype(np.int32), side,
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in WORDS.split(", ")])

    return chunks.select("chunk", "lengths", "learns", "tokens", "upper", "lower").mapInArrow(run, WORDS)


def classified(words: DataFrame) -> DataFrame:
    """``chunk, place, found``: counts over all chunks, from bit 7 on, class and, lowest, a flag.

    The flag is 1 in one row of each word.  A word has one row a chunk, so no word holds a large
    share of the rows.
    """
    whole = Window.partitionBy("hash")
    count = F.sum("n").over(whole)
    side = F.lit(0)
    for bit in range(CLASS_BITS):
        gap = F.shiftright("side", 12 * bit).bitwiseAND(F.lit(4095)) - 2048
        side = side + F.when(F.sum(gap).over(whole) > 0, 1 << bit).otherwise(0)
    kind = F.when(count > 1, side).otherwise(RARE)
    first = (F.min("chunk").over(whole) == F.col("chunk")).cast("long")
    return words.select("chunk", "place", (count * 128 + kind * 2 + first).alias("found"))


def ready_chunks(chunks: DataFrame, average: list[float]) -> DataFrame:
    """``READY``: chunks whose words have counts and classes, with the chunk's share of totals."""

    def meet(key: tuple, chunk: pa.Table, words: pa.Table) -> pa.Table:
        row = chunk.to_pylist()[0]
        order = np.argsort(words.column("place").to_numpy())
        found = words.column("found").to_numpy()[order]
        count, kind, new = found >> 7, found >> 1 & 63, (found & 1).astype(bool)
        mass = [int(count[new & (kind == k)].sum()) for k in range(CLASSES)]
        out = [row[c] for c in ("chunk", "ids", "uids", "learns", "lengths", "carry", "tokens", "upper")]
        out += [count.astype("<i8").tobytes(), kind.astype(np.int8).tobytes()]
        out += [int((new & test).sum()) for test in (count > 0, count == 1, count == 2)]
        return pa.Table.from_batches([batch_of(READY, [(*out, mass)])])

    words = classified(distinct_words(chunks, average))
    held = chunks.drop("lower", "sides", "learned")
    met = held.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(meet, READY)
    return settle(met, "maxent-ready")


class Batch:
    """A chunk's tokens as classes and rows of weights."""

    def __init__(self, row: dict):
        self.row, self.lengths = row, np.array(row["lengths"])
        self.tokens = unpack(row["tokens"], int(self.lengths.sum()))
        words = np.frombuffer(row["upper"], "<u4")[self.tokens]
        self.classes = np.frombuffer(row["classes"], np.int8)[self.tokens].astype(np.int64)
        starts = (np.cumsum(self.lengths) - self.lengths)[self.lengths > 0]
        past = []
        for back in (1, 2, 3):
            before = np.full(len(words), START, np.uint32)
            before[back:] = words[:-back]
            for place in range(back):
                at = starts[1:] + place
                before[at[at < len(words)]] = START
                if place < len(words):  # the first piece may go on from another chunk
                    before[place] = row["carry"][3 - back + place]
            past.append(before)
        # short pieces: a history reaches no further than its own piece
        for back in (2, 3):
            hidden = past[back - 2] == START
            past[back - 1][hidden] = START
        one, two, three = past
        mixed = (one * MIX[0], two * MIX[1], three * MIX[2], (one * MIX[3] ^ two * MIX[1]) * MIX[4])
        self.rows = np.stack([(m ^ (m >> np.uint32(15))) * MIX[4] >> np.uint32(32 - BUCKET_BITS) for m in mixed])

    def learned(self) -> tuple[np.ndarray, np.ndarray]:
        learn = np.repeat(np.array(self.row["learns"]), self.lengths)
        return self.rows[:, learn].astype(np.uint16), self.classes[learn]


def centred_logits(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logits of the classes less their maximum, a row a token, and the logarithm of their norm."""
    logits = weights.take(rows[0], axis=0)
    part = np.empty_like(logits)
    for feature in rows[1:]:
        logits += weights.take(feature, axis=0, out=part, mode="clip")
    logits += bias
    logits -= logits.max(axis=1, keepdims=True)
    return logits, np.log(np.exp(logits, out=part).sum(axis=1, keepdims=True))


def log_probabilities(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Natural logarithms of the classes' probabilities, a row a token."""
    logits, norm = centred_logits(weights, bias, rows)
    logits -= norm
    return logits


def group_sums(values: np.ndarray, order: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``np.add.reduceat(values[order], starts)``, to the last bit.

    That takes a step for each group and column, and most groups are small: those are added up
    side by side, in the same order (the first row to the sum of the others).
    """
    sizes = np.diff(starts, append=len(order))
    total = values.take(order[starts], axis=0)
    small = np.flatnonzero((sizes > 1) & (sizes <= SMALL_GROUP))
    small = small[np.argsort(-sizes[small], kind="stable")]
    if len(small):
        at, larger = starts[small], -sizes[small]
        rest = values.take(order[at + 1], axis=0)
        for k in range(2, -int(larger[0])):
            number = np.searchsorted(larger, -k)  # groups of more than k rows
            rest[:number] += values.take(order[at[:number] + k], axis=0)
        total[small] += rest
    large = np.flatnonzero(sizes > SMALL_GROUP)
    if len(large):
        ends = np.cumsum(sizes[large])
        inside = np.arange(ends[-1]) + np.repeat(starts[large] - ends + sizes[large], sizes[large])
        total[large] = np.add.reduceat(values.take(order[inside], axis=0), ends - sizes[large], axis=0)
    return total


class Trainer:
    """AdaGrad steps on a copy of the weights; the bias is the last row."""

    def __init__(self, weights: np.ndarray, step: float):
        self.start, self.weights, self.step = weights, weights.copy(), step
        self.squares = np.full(len(weights), 1e-2, np.float32)

    def learn(self, rows: np.ndarray, classes: np.ndarray) -> None:
        for low in range(0, len(classes), BATCH):
            here, target = rows[:, low : low + BATCH], classes[low : low + BATCH]
            gaps = np.exp(log_probabilities(self.weights, self.weights[-1], here))
            gaps[np.arange(len(target)), target] -= 1
            keys = here.ravel()
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            starts = np.flatnonzero(np.diff(keys, prepend=-1 if len(keys) == 0 else int(keys[0]) - 1))
            total = group_sums(gaps, order % len(target), starts)
            self.update(keys[starts].astype(np.int64), total)
            self.update(np.array([len(self.weights) - 1]), gaps.sum(axis=0, keepdims=True))

    def update(self, touched: np.ndarray, gradient: np.ndarray) -> None:
        """A step on different rows of weights; in blocks, which stay in the processor's cache."""
        for low in range(0, len(touched), UPDATE_ROWS):
            here, total = touched[low : low + UPDATE_ROWS], gradient[low : low + UPDATE_ROWS]
            self.squares[here] += (total * total).mean(axis=1)
            move = np.multiply(total, self.step, dtype=np.float64)
            move /= np.sqrt(self.squares[here]).astype(np.float64)[:, None]
            self.weights[here] = self.weights.take(here, axis=0) - move

    def changes(self, member: int) -> Iterator[pa.RecordBatch]:
        change = self.weights - self.start
        touched = change.any(axis=1)
        for block, low in enumerate(range(0, len(change), BLOCK_ROWS)):
            pick = touched[low : low + BLOCK_ROWS]
            if pick.any():
                half = change[low : low + BLOCK_ROWS].astype(np.float16)
                yield batch_of(CHANGES, [(member, block, half.tobytes(), pick.astype("<i4").tobytes())])


def averaged(changes: DataFrame, members: int) -> np.ndarray:
    """The average change of each row of weights over the members that touched it.

    Groups of some ``FAN_IN`` messages are added up, level by level; one row a block reaches the
    driver.  ``members`` is an upper bound.
    """

    def add(kind: type):
        def run(key: tuple, messages: pa.Table) -> pa.Table:
            total, touched = 0, 0
            for row in messages.sort_by("member").to_pylist():
                total = total + np.frombuffer(row["total"], kind).astype(np.float32)
                touched = touched + np.frombuffer(row["touched"], "<i4")
            out = (key[0].as_py(), key[1].as_py(), total.tobytes(), touched.astype("<i4").tobytes())
            return pa.Table.from_batches([batch_of(CHANGES, [out])])

        return run

    kind = np.float16
    while True:
        members = -(-members // FAN_IN)
        group = F.pmod(F.xxhash64("member"), F.lit(members)).cast("long")
        grouped = changes.withColumn("group", group)
        changes = grouped.groupBy("group", "block").applyInArrow(add(kind), CHANGES)
        kind = np.float32
        if members <= 1:
            break
    out = np.zeros((BUCKETS + 1, CLASSES), np.float32)
    for row in changes.collect():
        low = row.block * BLOCK_ROWS
        total = np.frombuffer(row.total, np.float32).reshape(-1, CLASSES)
        out[low : low + len(total)] = total / np.maximum(np.frombuffer(row.touched, "<i4"), 1)[:, None]
    return out


def train(ready: DataFrame, mass: np.ndarray, chunks: int) -> np.ndarray:
    """Weights with the bias as last row; ``mass`` is the training tokens of each class.

    ``chunks`` is the number of rows of ``ready``.
    """
    spark = ready.sparkSession
    weights = np.zeros((BUCKETS + 1, CLASSES), np.float32)
    present = mass > 0
    present[RARE] = True  # the unknown word is there at any rate
    weights[-1] = np.where(present, np.log((mass + 1) / (mass.sum() + CLASSES)), -100)
    for number in range(ROUNDS if mass.sum() else 0):
        given = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], given=given, number=number) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            trainer = None
            for batch in batches:
                for row in batch.to_pylist():
                    trainer = trainer or Trainer(given.value, STEP / np.sqrt(1 + number))
                    trainer.learn(*Batch(row).learned())
            if trainer is not None:
                yield from trainer.changes(TaskContext.get().partitionId())

        turn = ready.where(F.pmod(F.xxhash64("chunk"), F.lit(ROUNDS)) == number)
        turn = turn.select("lengths", "learns", "carry", "tokens", "upper", "classes")
        # a task that learns has a chunk at least
        weights = weights + averaged(turn.mapInArrow(run, CHANGES), chunks)
        given.unpersist()
    return weights


def score_documents(docs: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, learned, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    chunks = build_chunks(docs, id_col, text_col, learns)
    sums = [F.sum(F.get("sides", F.lit(b))) for b in range(CLASS_BITS)]
    *sides, learned = chunks.agg(*sums, F.sum("learned")).first()
    average = [(s or 0) / max(1, learned or 0) for s in sides]
    ready = ready_chunks(chunks, average)
    discard(chunks)  # all that follows reads the chunks with their words
    totals = [F.sum(c) for c in ("distinct", "once", "twice")]
    masses = [F.sum(F.get("mass", F.lit(k))) for k in range(CLASSES)]
    numbers = [x or 0 for x in ready.agg(F.count(F.lit(1)), *totals, *masses).first()]
    (held, distinct, once, twice), mass = numbers[:4], np.array(numbers[4:], float)
    tokens = int(mass.sum())
    given = docs.sparkSession.sparkContext.broadcast(train(ready, mass, held))
    # of the class of rare words, the unknown one's share and that of each word met once
    unknown = (once + 1) / (once + 2 * twice + 2) if once else 1.0
    single = (1 - unknown) / max(1, once)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = given.value
        for batch in batches:
            for row in batch.to_pylist():
                work = Batch(row)
                kinds = np.frombuffer(row["classes"], np.int8)
                counts = np.frombuffer(row["counts"], "<i8")
                base = np.log10((counts + SMOOTH) / (tokens + SMOOTH * (distinct + 1)))
                share = np.where(counts > 1, counts / np.maximum(mass[kinds], 1), np.where(counts == 1, single, unknown))
                inside, here = np.log10(share), work.tokens
                score = np.zeros(len(here))
                for low in range(0, len(here) if tokens else 0, BATCH):
                    part = slice(low, low + BATCH)
                    logits, norm = centred_logits(weights, weights[-1], work.rows[:, part])
                    mine = logits[np.arange(len(logits)), work.classes[part]] - norm[:, 0]
                    score[part] = mine / np.log(10) + inside[here[part]]
                starts = np.cumsum(work.lengths) - work.lengths
                columns = [row["uids"], row["ids"], row["learns"], work.lengths]
                columns += [np.add.reduceat(v, starts) for v in ((counts[here] > 0).astype(np.int64), base[here], score)]
                yield batch_of(SCORES, list(zip(*columns)))

    pieces = ready.drop("distinct", "once", "twice", "mass").mapInArrow(run, SCORES)
    total = [F.sum(c).alias(c) for c in ("n_tokens", "n_known")]
    return pieces.groupBy("uid").agg(
        F.first("doc_id").alias("doc_id"), F.first("learns").alias("learned"), *total,
        F.lit(tokens).cast("long").alias("train_tokens"), F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    ).drop("uid")

"""LM scoring: a bigram model in a log-frequency Bloom filter.

Counts of n-grams are quantised to q = 1 + floor(log2(count)) and an n-gram is put into the filter once
for each level 1..q, so a count is read back by probing level after level until one is missing. An
n-gram seen once has one entry; level 0 is one never seen. The probability of a word after another mixes
the bigram estimate with the unigram one (Dirichlet smoothing). Unigrams are divided by the sum of all quantised
counts; pairs take the low end of their level and contexts the high end, so the probabilities of a
context's words add up to one at most (but for the filter's false positives).

Beside it stands an exact add-half unigram score. Its counts are exact for all words: the most
frequent words (by levels, as many as fit into ``max_words``) are broadcast, rarer ones meet their
occurrences in a join on the word's hash.

Scale: every task sums n-grams of its slices before the shuffle and sends them as sorted arrays, one
row per shard, so a word in all documents arrives as one number per task. The number of shards follows from the
bytes of the training texts (``SHARD_BYTES`` each). Each shard counts its own
n-grams and builds its own segment of the filter, which has ``ROOMY`` bits for each entry. What is
broadcast is bounded by parameters: ``2**filter_bits`` bits and ``max_words`` words. Words are in the filter from
their first occurrence on, pairs from ``PAIR_LEVEL`` on (most pairs are seen once). If that would
crowd the filter (under ``BITS_PER_ENTRY`` bits for each entry), more of the lowest levels of pairs (and of words, should they
alone fill half of it) are left out, which
follows from the levels' counts over all documents. N-grams under that cut are not lost: what the
filter does not know is asked of the shards, a batch of texts at a time, in packed rows, and a shard answers
exactly, with sums per text. So scores depend on the filter's size only in its false positives (about 0.65% of
absent n-grams when it is full).

Defined results: a null text is empty and has the end token alone. A null id counts as the empty
text in the split. Repeated rows are learnt from and scored each by itself. Without any training
document the unigram counts are zero and V is zero.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.llm import common

FOLDS = 5
HELD_OUT = 1
FILTER_BITS = 28
MAX_WORDS = 1 << 18
BITS_PER_ENTRY = 12
#: Lowest level of the pairs in the filter: those seen twice or more.
PAIR_LEVEL = 2
#: Bits for each entry while they do not fill ``2**filter_bits``.
ROOMY = 64
PROBES = 4
#: Weight of the unigram distribution in the smoothed bigram, in counts (chosen on fold 2, learning from 0, 3 and 4).
PRIOR = 1024.0
#: A count of a level, as a multiple of the level's low end.
MIDDLE = 1.4
#: Text a task learns from before it sends its counts, and scores before it sends its questions.
FLUSH_BYTES = 24 << 20
#: Training text whose n-grams make up a shard.
SHARD_BYTES = 32 << 20

_TO_SPACE = bytes(32 if b in b" \t\n\x0b\x0c\r" else b for b in range(256))
END = np.uint64(0x5851F42D4C957F2D)


def held_out(doc_id: Column, folds: int = FOLDS, part: int = HELD_OUT) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == part


def token_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of all tokens in order; each text ends with the end token."""
    blob = b" ".join((t or b"").lower().translate(_TO_SPACE) for t in texts)
    sizes = np.array([len(t) if t else 0 for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])[:len(texts)]
    data = np.frombuffer(blob, np.uint8)
    starts, ends = common.word_spans(data)
    word = common.mix(common.Prefix(data).raw(starts, ends)) if len(starts) else np.zeros(0, np.uint64)
    of = np.searchsorted(begin, starts, "right") - 1
    last = np.searchsorted(of, np.arange(len(texts)), "right")
    return np.insert(word, last, END), np.insert(of, last, np.arange(len(texts)))


def pair_hashes(tokens: np.ndarray) -> np.ndarray:
    """Hash of every token together with the one before it (the end token before the first)."""
    before = np.concatenate([[END], tokens[:-1]])
    return common.mix(before * np.uint64(0x9FB21C651E98DF25) + tokens)


def _merge(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted hashes with their summed counts."""
    if not len(h):
        return h, c
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    return h[first], np.add.reduceat(c, first)


# --- learning ---------------------------------------------------------------------------------

def count_ngrams(texts: DataFrame, shards: int) -> DataFrame:
    """(shard, order, h, c): each task's n-grams as sorted arrays, dealt to shards by their hash. Those found more
    than once come first, and their counts are ``c``; the others have a count of one."""

    def run(batches):
        held: dict[int, list] = {1: [], 2: []}

        def flush():
            rows = []
            for order, parts in held.items():
                if not parts:
                    continue
                h, c = _merge(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                shard = ((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
                edges = np.searchsorted(shard, np.arange(shards + 1).astype(np.uint64))
                for s in np.flatnonzero(np.diff(edges)).tolist():
                    hs, cs = h[edges[s]:edges[s + 1]], c[edges[s]:edges[s + 1]]
                    rows.append((s, order, np.concatenate([hs[cs > 1], hs[cs == 1]]).tobytes(),
                                 cs[cs > 1].astype("<u4").tobytes()))
                parts.clear()
            cols = list(zip(*rows, strict=True)) or [()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.binary()),
                 pa.array(cols[3], pa.binary())], ["shard", "order", "h", "c"])

        size = 0
        for _, part in common.slices(batches, 0):
            tokens, _ = token_hashes(part)
            for order, h in ((1, tokens), (2, pair_hashes(tokens))):
                held[order].append(np.unique(h, return_counts=True))
            size += sum(len(t) for t in part if t)
            if size >= FLUSH_BYTES:
                yield flush()
                size = 0
        yield flush()

    return texts.mapInArrow(run, "shard int, order int, h binary, c binary")


def levels(c: np.ndarray) -> np.ndarray:
    """1 + floor(log2(count)); 0 for a count of 0."""
    return np.frexp(c.astype(float))[1]


def low_end(q: np.ndarray) -> np.ndarray:
    """Smallest count of each level."""
    return np.where(q > 0, 2.0 ** (q - 1), 0.0)


def middle(q: np.ndarray) -> np.ndarray:
    """A count that stands for each level (level 1 is a count of 1 alone)."""
    return np.where(q > 1, MIDDLE, 1.0) * low_end(q)


def high_end(q: np.ndarray) -> np.ndarray:
    """Bound on the counts of each level."""
    return np.where(q > 0, 2.0 ** q, 0.0)


def merge_shards(parts: DataFrame) -> DataFrame:
    """One row per shard and order: its distinct n-grams, counts and the number of n-grams of each level.

    Words keep their exact counts (8 bytes), pairs the levels of theirs (1 byte).
    """
    import pandas as pd

    def merge(group):
        order = int(group["order"].iloc[0])
        hs = [np.frombuffer(x, np.uint64) for x in group["h"]]
        cs = [np.ones(len(x), np.int64) for x in hs]
        for c, more in zip(cs, group["c"], strict=True):
            c[:len(more) // 4] = np.frombuffer(more, "<u4")
        h, c = _merge(np.concatenate(hs), np.concatenate(cs))
        q = levels(c)
        return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "order": [order], "h": [h.tobytes()],
                             "c": [(c if order == 1 else q.astype(np.uint8)).tobytes()], "total": [int(c.sum())],
                             "distinct": [len(h)], "of_level": [np.bincount(q, minlength=64).tolist()]})

    return parts.groupBy("shard", "order").applyInPandas(
        merge, "shard int, order int, h binary, c binary, total long, distinct long, of_level array<long>")


def _slots(h: np.ndarray, level: int, order: int, bits: int, probe: int) -> np.ndarray:
    salt = ((level * 8 + order) * PROBES + probe) * 0xA24BAED4963EE407 % (1 << 64)
    x = common.mix(h + np.uint64(salt))
    return ((x >> np.uint64(32)) * np.uint64(bits)) >> np.uint64(32)


def build_segments(merged: DataFrame, segment_bits: int, min_levels: dict[int, int]) -> DataFrame:
    """(shard, bits): every shard's segment of the filter, one row for each order (to be joined by or).

    The stored rows are read where they lie; nothing is shuffled.
    """

    def build(batches):
        for batch in batches:
            for shard, order, hs, cs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                flags = np.zeros(segment_bits, bool)
                h = np.frombuffer(hs, np.uint64)
                q = levels(np.frombuffer(cs, np.int64)) if order == 1 else np.frombuffer(cs, np.uint8).astype(np.int64)
                for level in range(min_levels[order], int(q.max(initial=0)) + 1):
                    h, q = h[q >= level], q[q >= level]
                    for probe in range(PROBES):
                        flags[_slots(h, level, order, segment_bits, probe)] = True
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int32()), pa.array([np.packbits(flags).tobytes()])], ["shard", "bits"])

    return merged.select("shard", "order", "h", "c").mapInArrow(build, "shard int, bits binary")


class Filter:
    """Quantised counts by repeated membership probes."""

    def __init__(self, segments: list[tuple[int, bytes]], shards: int, segment_bits: int, min_levels: dict[int, int]):
        size = segment_bits // 8
        self.bits = np.zeros(shards * size, np.uint8)
        for s, data in segments:
            self.bits[s * size:(s + 1) * size] |= np.frombuffer(data, np.uint8)
        self.shards, self.segment_bits, self.min_levels = shards, segment_bits, min_levels

    def level(self, h: np.ndarray, order: int) -> np.ndarray:
        """Highest level that is present without a gap below it; 0 for none."""
        out = np.zeros(len(h), np.int64)
        shard = ((h >> np.uint64(32)) * np.uint64(self.shards)) >> np.uint64(32)
        at, level = np.arange(len(h)), self.min_levels[order]
        while len(at):
            for probe in range(PROBES):
                slot = _slots(h[at], level, order, self.segment_bits, probe) + shard[at] * np.uint64(self.segment_bits)
                slot = slot.astype(np.int64)
                at = at[(self.bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1]
            out[at] = level
            level += 1
        return out


class Model:
    """The filter, the words broadcast with exact counts, and the totals."""

    def __init__(self, filter_: Filter, words: np.ndarray, counts: np.ndarray, n: int, v: int,
                 mass: float):
        self.filter, self.words, self.counts, self.n, self.v = filter_, words, counts, n, v
        self.mass = mass  # sum of the words' quantised counts, so that unigrams add up to one

    def exact(self, h: np.ndarray) -> np.ndarray:
        """Count of each word, -1 if it is not among the broadcast ones."""
        if not len(self.words):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.counts[at], -1)

    def unigram(self, q: np.ndarray) -> np.ndarray:
        """Probability of a word of each level."""
        return (middle(q) + 0.5) / (self.mass + 0.5 * (self.v + 1))

    def log_probs(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """log10 of the smoothed probability of each token after the one before it, as far as it is known here.

        (sum of the known parts, levels, pair hashes, which words and which pairs have to be looked up). A
        token's part is log10(seen + PRIOR * unigram), its context's -log10(context + PRIOR).
        """
        word, back = np.unique(tokens, return_inverse=True)
        level = self.filter.level(word, 1)
        exact = self.exact(word)
        level = np.where((level == 0) & (exact > 0), levels(np.maximum(exact, 0)), level)
        least = self.filter.min_levels
        open_word = ((level == 0) & (exact < 0) & (least[1] > 1))[back]
        level = level[back]
        pairs = pair_hashes(tokens)
        pair = self.filter.level(pairs, 2)
        open_pair = ((pair == 0) & (least[2] > 1)) | open_word
        # the token before; before a text's first token stands the end token, whose level is that of the texts' ends
        ends = np.flatnonzero(tokens == END)
        before = np.concatenate([ends[:1], np.arange(len(tokens) - 1)])
        known = np.where(open_pair, 0.0, np.log10(low_end(pair) + PRIOR * self.unigram(level)))
        known -= np.where(open_word[before], 0.0, np.log10(high_end(level[before]) + PRIOR))
        return known, level, pairs, open_word, open_pair


def learn(training: DataFrame, filter_bits: int = FILTER_BITS, max_words: int = MAX_WORDS,
          shard_bytes: int = SHARD_BYTES) -> tuple[Model, DataFrame]:
    """(model, rest) from a frame with the one column ``text``: ``rest`` has a row per shard and order, as
    ``merge_shards`` makes them, of the words that are not broadcast and the pairs that are not in the filter."""
    size = training.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(16, -(-size // shard_bytes))
    merged = common.materialise(merge_shards(count_ngrams(training, shards)))
    stats = merged.groupBy("order").agg(
        F.sum("total").alias("total"), F.sum("distinct").alias("distinct"),
        *(F.sum(F.get("of_level", F.lit(i))).alias(f"l{i}") for i in range(64))).collect()  # two rows
    by = {r["order"]: r for r in stats}
    n, v = (int(by[1]["total"]), int(by[1]["distinct"])) if 1 in by else (0, 0)
    entries = {1: [0] * 66, 2: [0] * 66}  # entries of the filter if levels start at i
    for order, row in by.items():
        at_least = 0
        for i in range(63, 0, -1):
            at_least += int(row[f"l{i}"] or 0)
            entries[order][i] = entries[order][i + 1] + at_least
    capacity = (1 << filter_bits) // BITS_PER_ENTRY
    low = next(i for i in range(1, 66) if 2 * entries[1][i] <= capacity)
    # a pair is not more frequent than its word, so it is under the cut if its word is
    min_levels = {1: low, 2: next(i for i in range(max(low, PAIR_LEVEL), 66) if entries[1][low] + entries[2][i] <= capacity)}
    filled = entries[1][low] + entries[2][min_levels[2]]
    segment_bits = max(8, min(1 << filter_bits, ROOMY * filled) // shards // 8 * 8)
    segments = [(r["shard"], bytes(r["bits"])) for r in build_segments(merged, segment_bits, min_levels).collect()]

    word_levels = [int(by[1][f"l{i}"] or 0) if 1 in by else 0 for i in range(64)]
    word_level = next(i for i in range(65) if sum(word_levels[i:]) <= max_words)
    words = merged.filter("order = 1").select("h", "c")

    def frequent(batches):
        for batch in batches:
            for hs, cs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                h, c = np.frombuffer(hs, np.uint64), np.frombuffer(cs, np.int64)
                ok = levels(c) >= word_level
                yield pa.RecordBatch.from_arrays([pa.array([h[ok].tobytes()]), pa.array([c[ok].tobytes()])], ["h", "c"])

    rows = words.mapInArrow(frequent, "h binary, c binary").collect()  # at most max_words words in all
    h = np.concatenate([np.zeros(0, np.uint64), *(np.frombuffer(r["h"], np.uint64) for r in rows)])
    c = np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(r["c"], np.int64) for r in rows)])
    order = np.argsort(h)
    mass = sum(float(middle(np.array(i))) * k for i, k in enumerate(word_levels))
    model = Model(Filter(segments, shards, segment_bits, min_levels), h[order], c[order], n, v, mass)

    def under(batches):
        for batch in batches:
            for shard, order, hs, cs in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                h, c = np.frombuffer(hs, np.uint64), np.frombuffer(cs, np.int64 if order == 1 else np.uint8)
                ok = levels(c) < word_level if order == 1 else c < min_levels[2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard], pa.int64()), pa.array([order], pa.int32()), pa.array([h[ok].tobytes()]),
                     pa.array([c[ok].tobytes()])], ["shard", "order", "h", "c"])

    rest = merged.select("shard", "order", "h", "c").mapInArrow(under, "shard long, order int, h binary, c binary")
    return model, rest


# --- scoring ----------------------------------------------------------------------------------

#: Questions to a shard: the pair's level, given its word's (0 to 63); a word's exact count; a word's level as a context;
#: the level of a word for a pair that waits for it.
EXACT, CONTEXT, WAITING = 100, 101, 102
_ASK = "key long, batch long, ids array<{kind}>, held array<boolean>, base binary, h binary, row binary, what binary, other binary"
_ASK_NAMES = ["key", "batch", "ids", "held", "base", "h", "row", "what", "other"]
_TOLD = "batch long, ids array<{kind}>, held array<boolean>, base binary, row binary, logs binary, known binary, score binary"
_TOLD_NAMES = ["batch", "ids", "held", "base", "row", "logs", "known", "score"]


def _deal(shards: int, batch: int, h, row, what, other) -> list[tuple]:
    """Questions of a batch, one row of packed columns per shard."""
    shard = ((h >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
    order = np.argsort(shard, kind="stable")
    edges = np.searchsorted(shard[order], np.arange(shards + 1).astype(np.uint64))
    out = []
    for s in np.flatnonzero(np.diff(edges)).tolist():
        at = order[edges[s]:edges[s + 1]]
        waits = at[what[at] == WAITING]
        out.append((s, batch, None, None, None, h[at].tobytes(), row[at].astype("<u4").tobytes(),
                    what[at].tobytes(), other[waits].tobytes()))
    return out


def _asks(rows: list[tuple], ids: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [()] * 9
    types = [pa.int64(), pa.int64(), pa.list_(ids), pa.list_(pa.bool_()), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], _ASK_NAMES)


def _lookup(keys: np.ndarray, values: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of sorted keys; 0 for others."""
    if not len(keys):
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, values[at], 0).astype(np.int64)


def lm_score(docs: DataFrame, held_out_col: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
             filter_bits: int = FILTER_BITS, max_words: int = MAX_WORDS, flush_bytes: int = FLUSH_BYTES,
             shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out_col`` (a condition on the input) marks the rows that are not learnt from.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    mark = held_out(F.col(id_col)) if held_out_col is None else F.coalesce(held_out_col, F.lit(False))
    narrow = docs.select(F.col(id_col).alias("doc_id"), mark.alias("held_out"),
                         F.col(text_col).cast("string").alias("text"))
    model, rest = learn(narrow.filter(~F.col("held_out")).select("text"), filter_bits, max_words, shard_bytes)
    n, total, shards, least = model.n, model.n + 0.5 * (model.v + 1), model.filter.shards, model.filter.min_levels
    mass, v = model.mass, model.v
    shared = spark.sparkContext.broadcast(model)
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def ask(batches):
        """Each batch's known sums (key -1 - batch), and its questions (key: the shard)."""
        from pyspark import TaskContext

        known, batch_id, ids_type = shared.value, TaskContext.get().partitionId() << 24, pa.int64()
        ids, held, sums, asked, rows, size = [], [], [], [], 0, 0

        def flush():
            nonlocal batch_id
            h, row, what, other = (np.concatenate([a[k] for a in asked]) for k in range(4))
            out = [(-1 - batch_id, batch_id, ids, held, np.concatenate(sums, axis=1).tobytes(), *[None] * 4),
                   *_deal(shards, batch_id, h, row, what, other)]
            batch_id += 1
            return _asks(out, ids_type)

        for batch in batches:
            ids_type = batch.schema.field(0).type
            for (some, marks), texts in common.slices([batch], 2):
                tokens, of = token_hashes(texts)
                word, back = np.unique(tokens, return_inverse=True)
                counts = known.exact(word)[back]
                inside = counts >= 0
                part, level, pair, open_word, open_pair = known.log_probs(tokens)
                logs = np.where(inside, np.log10(np.maximum(counts, 0) + 0.5), 0.0)
                count = lambda x, w=None: np.bincount(of[x] if x is not None else of, w, len(texts)).astype(float)
                sums.append(np.stack([count(None), count(counts > 0), count(None, logs), count(None, part)]))
                ends = np.flatnonzero(tokens == END)
                before = np.concatenate([ends[:1], np.arange(len(tokens) - 1)])  # every text has its end token
                context = open_word[before]
                ready = open_pair & ~open_word
                waits = open_pair & open_word
                parts = [(tokens[~inside], of[~inside], EXACT, None), (tokens[before][context], of[context], CONTEXT, None),
                         (pair[ready], of[ready], level[ready], None), (tokens[waits], of[waits], WAITING, pair[waits])]
                for h, row, what, other in parts:
                    asked.append((h, row + rows, np.broadcast_to(np.asarray(what, np.uint8), h.shape),
                                  np.zeros(len(h), np.uint64) if other is None else other))
                ids += some
                held += marks
                rows += len(texts)
                size += sum(len(t) for t in texts if t)
                if size >= flush_bytes:
                    yield flush()
                    ids, held, sums, asked, rows, size = [], [], [], [], 0, 0
        if rows:
            yield flush()

    def low_of(table: pa.Table, order: int, dtype) -> tuple[np.ndarray, np.ndarray]:
        for o, h, c in zip(table["order"].to_pylist(), table["h"].to_pylist(), table["c"].to_pylist(), strict=True):
            if o == order:
                return np.frombuffer(h, np.uint64), np.frombuffer(c, dtype)
        return np.zeros(0, np.uint64), np.zeros(0, dtype)

    def answer(asks: pa.Table, held: pa.Table) -> pa.Table:
        """A shard's sums for each batch's texts; sums already known and questions for other shards pass through."""
        words, pairs = low_of(held, 1, np.int64), low_of(held, 2, np.uint8)
        out = []
        for r in asks.to_pylist():
            if r["key"] < 0:
                out.append((r["batch"], r["ids"], r["held"], r["base"], *[None] * 4, *[None] * 4))
                continue
            h, row = np.frombuffer(r["h"], np.uint64), np.frombuffer(r["row"], "<u4").astype(np.int64)
            what, other = np.frombuffer(r["what"], np.uint8), np.frombuffer(r["other"], np.uint64)
            of_word = what >= EXACT
            c = np.zeros(len(h), np.int64)
            c[of_word] = _lookup(*words, h[of_word])
            q = np.where(of_word, levels(c), 0)
            q[~of_word] = _lookup(*pairs, h[~of_word])
            word_p = (middle(np.where(of_word, 0, what)) + 0.5) / (mass + 0.5 * (v + 1))
            score = np.where(what < EXACT, np.log10(low_end(q) + PRIOR * word_p), 0.0)
            score -= np.where(what == CONTEXT, np.log10(high_end(q) + PRIOR), 0.0)
            exact = what == EXACT
            size = int(row.max()) + 1
            touched = np.unique(row)
            logs = np.bincount(row[exact], np.log10(c[exact] + 0.5), size)[touched] if exact.any() else np.zeros(0)
            seen = np.bincount(row[exact & (c > 0)], minlength=size)[touched] if exact.any() else np.zeros(0, np.int64)
            told = (r["batch"], None, None, None, touched.astype("<u4").tobytes(), logs.tobytes(),
                    seen.astype("<u4").tobytes(), np.bincount(row, score, size)[touched].tobytes())
            out.append((*told, *[None] * 4))
            waits = what == WAITING
            for shard, *_, hs, rows, levels_, _ in _deal(shards, r["batch"], other, row[waits], q[waits].astype(np.uint8), other):
                out.append((r["batch"], *[None] * 7, hs, rows, levels_, shard))
        types = [pa.int64(), pa.list_(asks.schema.field("ids").type.value_type), pa.list_(pa.bool_()), *[pa.binary()] * 8, pa.int64()]
        cols = list(zip(*out, strict=True)) if out else [()] * 12
        return pa.table([pa.array(x, t) for x, t in zip(cols, types, strict=True)], names=[*_TOLD_NAMES, "h", "at", "what", "key"])

    def total_of(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        base = next(r for r in rows if r["base"] is not None)
        sums = np.frombuffer(base["base"]).reshape(4, -1).copy()
        packed = [r for r in rows if r["row"] is not None]
        # in one order whatever arrives first, so that sums are the same bits
        for r in sorted(packed, key=lambda r: (r["row"], r["score"], r["logs"])):
            at = np.frombuffer(r["row"], "<u4")
            sums[3, at] += np.frombuffer(r["score"])
            if r["logs"]:
                sums[2, at] += np.frombuffer(r["logs"])
                sums[1, at] += np.frombuffer(r["known"], "<u4")
        ids = table["ids"].type.value_type
        return pa.table({"doc_id": pa.array(base["ids"], ids), "held_out": pa.array(base["held"], pa.bool_()),
                         "n_tokens": pa.array(sums[0].astype(np.int64)), "n_known": pa.array(sums[1].astype(np.int64)),
                         "train_tokens": pa.array(np.full(sums.shape[1], n, np.int64)),
                         "base_score": pa.array(sums[2] - sums[0] * float(np.log10(total))), "score": pa.array(sums[3])})

    told_ddl = f"{_TOLD.format(kind=kind)}, h binary, at binary, what binary, key long"
    asks = narrow.mapInArrow(ask, _ASK.format(kind=kind))
    by_shard = rest.groupBy("shard")
    told = asks.groupBy("key").cogroup(by_shard).applyInArrow(answer, told_ddl)
    if least[1] > 1:  # some pairs waited for their words: their questions go on to the pairs' shards
        told = common.materialise(told)
        again = told.filter(F.col("key").isNotNull()).select(
            "key", "batch", "ids", "held", "base", "h", F.col("at").alias("row"), "what", F.lit(b"").alias("other"))
        told = told.filter(F.col("key").isNull()).unionAll(
            again.groupBy("key").cogroup(by_shard).applyInArrow(answer, told_ddl))
    return told.select(*_TOLD_NAMES).filter("base IS NOT NULL OR row IS NOT NULL").groupBy("batch").applyInArrow(
        total_of, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op8_lm_score(spark, sf_dir: str) -> DataFrame:
    return lm_score(common.table(spark, sf_dir, "documents"))

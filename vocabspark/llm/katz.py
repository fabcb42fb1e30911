"""Katz backoff language model over words, trained on part of the rows and evaluated on all.

Tokens of a text are its words (runs without white space, A-Z lower-cased) and one end. The model, of
order two, backs off from pairs to single tokens to the unknown word:

- pairs: ``P(w | h) = d_r * r / (c(h) + 1/2)`` for a pair seen ``r`` times in training, where ``d_r`` is the Good-Turing
  discount of small counts (up to ``CUT``; by absolute discounting if counts of counts give no
  valid one); otherwise ``alpha(h) * P(w)``, with ``alpha(h)`` such that all tokens sum to exactly one
  (the half count leaves every context some mass for what it has not seen);
- single tokens: ``P(w) = (1 - p0) * c(w) / N``, and ``p0`` (Good-Turing's share of tokens seen once) for all unknown
  words together.

Frequent words (at most ``TABLE_WORDS``, from the largest counts down by whole powers of two) have numbers in a
table that is sent to every task; it only makes occurrences smaller and spreads the commonest contexts. All other words go by
their hashes and have their own pairs like any other. So the table is bounded, while counts of all
words and of all pairs grow with the corpus and stay in partitioned tables.

Occurrences, not counts, are dealt out: each partition gets every occurrence of its pairs, and the training counts of
the rare words in them, counts the pairs of the training rows, evaluates all of them, and gives back a
partial sum for each document. A rare context lies in one partition with all its pairs, which settles all but the
discounts in its weight. Contexts with many occurrences are dealt by the pair, and pairs of the
hottest words are counted map-side and evaluated where the text is read, so no key is a bottleneck.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocabspark.llm.tables import by_chunk, fields_of, freed, limit_batches, stored, tidied
from vocabspark.llm.words import Words, chunks, mix, signed, words_of

# Counts up to this one are discounted.
CUT = 5
# Words told apart in pairs: 16 bytes each in every task.
TABLE_WORDS = 1 << 20
# Words (and symbols) whose pairs with each other are counted map-side.
HOT_WORDS = 1024
# Occurrences a partition is meant to hold: some 130 bytes each while it is counted.
BUCKET_TOKENS = 1_000_000
_HELD = 2 << 20
# Packed rows whose parts are added up at once.
_ROWS = 64

# Counts told apart: the discounted ones and the next, whose number the discounts need.
_TOLD = CUT + 1
_PARTS = [f"h{r}" for r in range(1, _TOLD + 1)]
_SUMS = [*_PARTS, "seen", "unseen", "known", "base"]


@dataclass
class Lexicon:
    """What every task knows of single tokens. Symbols: words, then rare (a mark: go by the hash), begin, end."""

    words: np.ndarray  # sorted hashes of frequent words
    counts: np.ndarray  # training counts of all symbols, none for the mark
    tokens: int  # N, ends included
    distinct: int  # V, the end included
    p0: float
    hot: np.ndarray  # place among the hottest symbols, or -1
    split: np.ndarray  # whether a context's pairs are dealt by the pair
    buckets: int

    @property
    def rare(self) -> int:
        return len(self.words)

    def log_p(self) -> np.ndarray:
        """log10 P of every symbol as a successor; begin never is one."""
        share = (1 - self.p0) * self.counts / max(self.tokens, 1)
        share[self.rare] = self.p0
        share[self.rare + 1] = 0
        return np.log10(np.maximum(share, 1e-300))

    def log_p_of(self, count: np.ndarray) -> np.ndarray:
        """The same of words by their counts."""
        return np.log10(np.where(count > 0, (1 - self.p0) * count / max(self.tokens, 1), self.p0))

    def log_base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))


def _symbols(found: Words, lexicon: Lexicon) -> np.ndarray:
    distinct, back = np.unique(found.hashes, return_inverse=True)
    if not len(lexicon.words) or not len(distinct):
        return np.full(len(found.hashes), lexicon.rare, np.int32)
    at = np.searchsorted(lexicon.words, distinct)
    at[at == len(lexicon.words)] = 0
    return np.where(lexicon.words[at] == distinct, at, lexicon.rare).astype(np.int32)[back]


def _laid(values: np.ndarray, bounds: np.ndarray, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Context and successor of every token, ends included."""
    start = np.append(0, np.cumsum(np.diff(bounds) + 1))
    context = np.empty(int(start[-1]), values.dtype)
    after = np.empty(int(start[-1]), values.dtype)
    inner = np.ones(len(after), bool)
    inner[start[1:] - 1] = False
    after[inner] = values
    after[start[1:] - 1] = end
    inner[:] = True
    inner[start[:-1]] = False
    context[inner] = values
    context[start[:-1]] = begin
    return context, after


def _pairs(symbols: np.ndarray, bounds: np.ndarray, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, successor and text of every token, as symbols."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds) + 1)
    return *_laid(symbols, bounds, lexicon.rare + 1, lexicon.rare + 2), owner


def _buckets(context, after, context_word, after_word, lexicon: Lexicon) -> np.ndarray:
    """The bucket of every occurrence: by the context, or by the pair where the context is split."""
    rare = lexicon.rare
    tail = np.where(after == rare, after_word, after.astype(np.uint64) + np.uint64(1))
    by = context.astype(np.uint64) + np.where(lexicon.split[context], mix(tail), np.uint64(0))
    by = np.where(context == rare, context_word, by)
    return (mix(by + np.uint64(1)) % np.uint64(lexicon.buckets)).astype(np.int64)


def _word_counts(rows: DataFrame) -> DataFrame:
    """``(word, n)``: how often each word hash occurs; each task sends a word once per block."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted():
            word, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch({"word": signed(word), "n": n.astype(np.int64)})

        for batch in batches:
            for part in chunks(batch, "text"):
                held.append(words_of(part.column("text")).hashes)
                size += len(held[-1])
                if size > _HELD:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    return rows.mapInArrow(tidied(count), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(training: DataFrame) -> tuple[Lexicon, DataFrame | None]:
    """Counts of single tokens, as far as every task needs them, and the table ``(word, n)`` of all others, if any."""
    counts = stored(_word_counts(training), "word-counts")
    ends = training.count()
    power = F.floor(F.log2(F.col("n").cast("double"))).cast("int")
    by_power = counts.groupBy(power.alias("power")).agg(F.count("*"), F.sum("n")).collect()
    total, distinct = sum(r[2] for r in by_power), sum(r[1] for r in by_power)
    least, taken = 62, 0
    for p, words, _ in sorted(by_power, reverse=True):
        if taken + words > TABLE_WORDS:
            break
        least, taken = p, taken + words
    table = counts.where(F.col("n") >= (1 << least)).toArrow()
    words = table["word"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    own = table["n"].to_numpy().astype(np.int64)[order]
    once = counts.where("n = 1").count()
    tokens = total + ends
    p0 = min(0.5, max(once / max(tokens, 1), 1 / (tokens + 1)))
    every = np.concatenate([own, [0, ends, ends]])
    buckets = max(1, -(-(tokens + tokens // 9) // BUCKET_TOKENS))
    # At most HOT_WORDS symbols can each hold such a share of all contexts.
    hottest = np.flatnonzero(every >= max(1, 3 * tokens // HOT_WORDS))
    hot = np.full(len(every), -1, np.int32)
    hot[hottest] = np.arange(len(hottest))
    split = every > max(1, tokens // (8 * buckets))
    others = counts.where(F.col("n") < (1 << least)) if taken < distinct else None
    return Lexicon(words[order], every, tokens, distinct + (ends > 0), p0, hot, split, buckets), others


def _hot_pairs(training: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Training counts of pairs of the hottest symbols, as a square; gathered, its size is fixed."""
    side = int(lexicon.hot.max()) + 1 if len(lexicon.hot) else 0
    sent = training.sparkSession.sparkContext.broadcast(fields_of(lexicon))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(*sent.value)
        square = np.zeros(side * side, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                found = words_of(part.column("text"))
                context, after, _ = _pairs(_symbols(found, lexicon), found.bounds, lexicon)
                x, y = lexicon.hot[context], lexicon.hot[after]
                keep = (x >= 0) & (y >= 0)
                square += np.bincount(x[keep].astype(np.int64) * side + y[keep], minlength=side * side)
        at = np.flatnonzero(square)
        yield pa.record_batch({"pair": at, "n": square[at]})

    square = np.zeros(side * side, np.int64)
    if side:
        table = training.mapInArrow(tidied(count), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
        square[table["pair"].to_numpy()] = table["n"].to_numpy()
    return square.reshape(side, side)


def _evaluate(context, after, count, owner, owners, counts: np.ndarray, log_p: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
    """Sums per owner of pairs with their training counts; contexts of unseen pairs, by owner."""
    out = {f"h{r}": np.bincount(owner[count == r], minlength=owners) for r in range(1, _TOLD + 1)}
    seen = count > 0
    value = np.log10(count[seen]) - np.log10(counts[context[seen]] + 0.5)
    out["seen"] = np.bincount(owner[seen], value, owners)
    gone = ~seen
    out["unseen"] = np.bincount(owner[gone], log_p[after[gone]], owners)
    order = np.argsort(owner[gone], kind="stable")
    sizes = np.bincount(owner[gone], minlength=owners)
    return out, context[gone][order], sizes


def _ends_of(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))


def _list(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(_ends_of(sizes), pa.array(values.astype(np.int32)))


def _context_rows(context, after, count, log_p) -> dict:
    """Of each context: how many successors were seen 1, 2, ... times, the larger counts, and the mass of all."""
    names, back = np.unique(context, return_inverse=True)
    n = len(names)
    out = {f"h{r}": np.bincount(back[count == r], minlength=n) for r in range(1, _TOLD + 1)}
    out["seen"] = np.bincount(back, np.where(count > _TOLD, count, 0), n)
    out["unseen"] = np.bincount(back, 10.0 ** log_p[after], n)
    return {"context": names, **out}


_OUT = (
    "key long, context int, " + ", ".join(f"{h} int" for h in _PARTS) + ", seen double, unseen double, known long, base double, "
    "lost array<int>"
)


def _table(key, context, columns: dict, lost=None) -> pa.Table:
    n = len(next(iter(columns.values())))
    zero = np.zeros(n)
    data = {"key": key if key is not None else pa.nulls(n, pa.int64()), "context": context if context is not None else pa.nulls(n, pa.int32())}
    for h in _PARTS:
        data[h] = pa.array(columns.get(h, zero)).cast(pa.int32())
    for name in ("seen", "unseen"):
        data[name] = pa.array(columns.get(name, zero)).cast(pa.float64())
    data["known"] = pa.array(columns.get("known", zero)).cast(pa.int64())
    data["base"] = pa.array(columns.get("base", zero)).cast(pa.float64())
    data["lost"] = lost if lost is not None else pa.nulls(n, pa.list_(pa.int32()))
    return pa.table(data)


_PACKED = (
    "target long, key array<long>, counts array<long>, value array<double>, base array<double>, lost array<int>, far array<double>, "
    "context array<int>, " + ", ".join(f"{h} array<int>" for h in _PARTS) + ", seen array<double>, unseen array<double>"
)

# Small counts of an entry in one number: of seen pairs by their counts, known words, and weights of common and of rare contexts.
_COUNTED = [*_PARTS, "known", "lost", "far"]
_BITS = 7
_MOST = (1 << _BITS) - 1
# Numbers that make the weight of a rare context.
_SHAPE = len(_PARTS) + 3


def _counts_of(packed: np.ndarray) -> dict[str, np.ndarray]:
    """The small counts of each entry."""
    return {name: packed >> np.int64(k * _BITS) & np.int64(_MOST) for k, name in enumerate(_COUNTED)}


def _packed(target: np.ndarray, key: np.ndarray, counts: dict, value: np.ndarray, base: np.ndarray, lost: np.ndarray, far: np.ndarray) -> pa.Table:
    """One row of arrays for each target, from entries in the order of their targets.

    With many partitions most entries stand for one occurrence: few columns, far fewer rows than pairs of partitions and
    documents. An entry whose counts do not fit is several of one key; ``lost`` and ``far`` are in the order of the entries.
    """
    fields = [np.asarray(counts[name], np.int64) for name in _COUNTED]
    times = np.maximum(1, -(-np.max(fields, axis=0) // _MOST)) if len(key) else np.zeros(0, np.int64)
    if times.max(initial=1) > 1:
        at = np.repeat(np.arange(len(key)), times)
        taken = (np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)) * _MOST
        fields = [np.clip(f[at] - taken, 0, _MOST) for f in fields]
        target, key, value, base = target[at], key[at], np.where(taken, 0, value[at]), np.where(taken, 0, base[at])
    packed = np.zeros(len(key), np.int64)
    for k, f in enumerate(fields):
        packed |= f << np.int64(k * _BITS)
    names, starts = np.unique(target, return_index=True)
    edges = np.append(starts, len(target))
    data = {"target": pa.array(names, pa.int64())}
    # A sum of nothing is made of whole numbers.
    for name, column in (("key", key), ("counts", packed), ("value", value.astype(float)), ("base", base.astype(float))):
        data[name] = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(column))
    for name, column, width in (("lost", lost.astype(np.int32), 1), ("far", far.astype(float), _SHAPE)):
        before = np.append(0, np.cumsum(fields[_COUNTED.index(name)]))[edges] * width
        data[name] = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(column))
    return pa.table(data)


def _packed_contexts(context: np.ndarray, columns: dict) -> pa.Table:
    """The parts of all contexts of a partition in one row."""
    data = {"target": pa.array([-1], pa.int64())}
    kinds = {"context": pa.int32(), **dict.fromkeys(_PARTS, pa.int32()), "seen": pa.float64(), "unseen": pa.float64()}
    ends = pa.array([0, len(context)], pa.int32())
    for name, kind in kinds.items():
        data[name] = pa.ListArray.from_arrays(ends, pa.array(context if name == "context" else columns[name]).cast(kind))
    return pa.table(data)


def _together(each: pa.Table, by_context: pa.Table) -> pa.Table:
    """Both kinds of rows, with empty lists where the other kind has something (null lists are very slow to read)."""
    names = [*each.column_names, *by_context.column_names[1:]]

    def filled(table: pa.Table, other: pa.Table) -> pa.Table:
        for name in names:
            if name not in table.column_names:
                kind = other.schema.field(name).type
                table = table.append_column(name, pa.array([[]] * table.num_rows, kind))
        return table.select(names)

    return pa.concat_tables([filled(each, by_context), filled(by_context, each)])


def _summed(parts: list[tuple[np.ndarray, ...]], buckets: int) -> pa.RecordBatch:
    """Parts ``(key, known, base, total)`` of many buckets added up by key: one row of arrays for each target."""
    key, *values = (np.concatenate(c) for c in zip(*parts))
    names, which = np.unique(key, return_inverse=True)
    target = (mix(names.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(target, kind="stable")
    targets, starts = np.unique(target[order], return_index=True)
    ends = pa.array(np.append(starts, len(order)).astype(np.int32))
    known, base, total = (np.bincount(which, v, len(names))[order] for v in values)
    lists = {"key": names[order], "known": known.astype(np.int64), "base": base, "total": total}
    return pa.record_batch({"target": targets, **{c: pa.ListArray.from_arrays(ends, pa.array(v)) for c, v in lists.items()}})


def _flat(table: pa.Table, name: str) -> np.ndarray:
    """The lists of all rows one after another; null is empty."""
    return np.concatenate([c.flatten().to_numpy() for c in table[name].chunks])


def score(docs: DataFrame, learns: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores every row by a model of the rows where ``learns`` holds.

    Returns per row ``(id, learned, n_tokens, n_known, train_tokens, base_score, score)``: tokens with the end, those
    seen in training, all training tokens, the log10 probability under additive smoothing with
    0.1, and under the backoff model.

    A null or empty text has the end alone. ``learns`` null counts as false. Rows with a null id are scored like
    any other; rows that repeat an id each count and each get their scores. Without training rows every
    word is unknown. Other columns are not read; an empty table gives an empty table.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id).alias("id"), F.coalesce(learns, F.lit(False)).alias("learns"), F.xxhash64(F.col(id), body).alias("key"), body.alias("text")
    )
    spark = docs.sparkSession
    # Packed rows are large: without a limit in bytes a task's whole share would be one batch.
    limit_batches(spark)
    training = rows.where("learns").select("text")
    lexicon, others = build_lexicon(training)
    square = _hot_pairs(training, lexicon)
    # Made once: every chunk and every bucket reads it, and it is as large as the table of words.
    sent = spark.sparkContext.broadcast((fields_of(lexicon), square, lexicon.log_p()))

    kind = docs.schema[id].dataType.simpleString()
    asking = others is not None

    def own(part: pa.RecordBatch) -> pa.RecordBatch:
        """What a row's text and the common tables settle."""
        fields, square, log_p = sent.value
        lexicon = Lexicon(*fields)
        found = words_of(part.column("text"))
        symbols = _symbols(found, lexicon)
        context, after, owner = _pairs(symbols, found.bounds, lexicon)
        owners = part.num_rows
        x, y = lexicon.hot[context], lexicon.hot[after]
        keep = (x >= 0) & (y >= 0)
        sums, lost, sizes = _evaluate(
            context[keep], after[keep], square[x[keep], y[keep]] if square.size else np.zeros(0, np.int64), owner[keep], owners, lexicon.counts, log_p
        )
        common = after != lexicon.rare
        counts = lexicon.counts[after[common]]
        sums["known"] = np.bincount(owner[common][counts > 0], minlength=owners)
        sums["base"] = np.bincount(owner[common], lexicon.log_base(counts), owners)
        table = _table(part.column("key"), None, sums, _list(lost, sizes))
        table = table.append_column("id", part.column("id")).append_column("learns", part.column("learns"))
        table = table.append_column("n_tokens", pa.array(np.diff(found.bounds) + 1))
        # Rare words, and the buckets in which their counts will be needed.
        rare = np.flatnonzero(~common) if asking else np.zeros(0, np.int64)
        context_word, after_word = _laid(found.hashes, found.bounds, 0, 0)
        bucket = _buckets(context[rare], after[rare], context_word[rare], after_word[rare], lexicon)
        sizes = np.bincount(owner[rare], minlength=owners)
        table = table.append_column("asked", pa.ListArray.from_arrays(_ends_of(sizes), pa.array(signed(after_word[rare]))))
        table = table.append_column("asking", pa.ListArray.from_arrays(_ends_of(sizes), pa.array(bucket)))
        return table.combine_chunks().to_batches()[0]

    settled = rows.mapInArrow(
        by_chunk(own, "text"), f"{_OUT}, id {kind}, learns boolean, n_tokens long, asked array<long>, asking array<long>"
    )
    settled = stored(settled, "rows")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Occurrences by bucket; rare words, in order, by their hashes."""
        lexicon = Lexicon(*sent.value[0])
        for batch in batches:
            for part in chunks(batch, "text"):
                keys = part.column("key").to_numpy()
                learns = part.column("learns").to_numpy(zero_copy_only=False)
                found = words_of(part.column("text"))
                symbols = _symbols(found, lexicon)
                context, after, owner = _pairs(symbols, found.bounds, lexicon)
                context_word, after_word = _laid(found.hashes, found.bounds, 0, 0)
                keep = np.flatnonzero((lexicon.hot[context] < 0) | (lexicon.hot[after] < 0))
                bucket = _buckets(context[keep], after[keep], context_word[keep], after_word[keep], lexicon)
                group = bucket * 2 + learns[owner[keep]]
                order = np.argsort(group.astype(np.uint16) if lexicon.buckets < 32768 else group, kind="stable")
                group, keep = group[order], keep[order]
                names, starts = np.unique(group, return_index=True)
                if not len(names):
                    continue
                edges = np.append(starts, len(group))
                ends = pa.array(edges.astype(np.int32))
                columns = {"context": pa.array(context[keep]), "after": pa.array(after[keep]), "key": pa.array(keys[owner[keep]])}
                columns = {c: pa.ListArray.from_arrays(ends, v) for c, v in columns.items()}
                for c, symbol, word in (("context_word", context, context_word), ("after_word", after, after_word)):
                    rare = np.flatnonzero(symbol[keep] == lexicon.rare)
                    ends = pa.array(np.searchsorted(rare, edges).astype(np.int32))
                    columns[c] = pa.ListArray.from_arrays(ends, pa.array(signed(word[keep[rare]])))
                none = pa.nulls(len(names), pa.list_(pa.int64()))
                yield pa.record_batch({"bucket": names // 2, "learns": names % 2 == 1, **columns, "word": none, "n": none})

    dealt = rows.select("key", "learns", "text").mapInArrow(
        tidied(deal),
        "bucket long, learns boolean, context array<int>, after array<int>, key array<long>, context_word array<long>, "
        "after_word array<long>, word array<long>, n array<long>",
    )
    if asking:
        asked = settled.select(F.inline(F.arrays_zip("asked", "asking"))).toDF("word", "bucket").distinct()
        told = asked.join(others, "word").groupBy("bucket").agg(F.collect_list(F.struct("word", "n")).alias("told"))
        told = told.select("bucket", F.lit(False).alias("learns"), F.col("told.word").alias("word"), F.col("told.n").alias("n"))
        dealt = dealt.unionByName(told, allowMissingColumns=True)

    def evaluated(table: pa.Table) -> pa.Table:
        lexicon = Lexicon(*sent.value[0])

        lengths = np.concatenate([c.fill_null([]).value_lengths().to_numpy() for c in table["key"].chunks])
        learns = np.repeat(table["learns"].to_numpy(), lengths)
        names, owner = np.unique(_flat(table, "key"), return_inverse=True)
        target = (mix(names.view(np.uint64)) % np.uint64(lexicon.buckets)).astype(np.int64)
        # Owners in the order of their targets.
        order = np.argsort(target, kind="stable")
        place = np.empty(len(names), np.int32)
        place[order] = np.arange(len(names), dtype=np.int32)
        owner, names, target = place[owner], names[order], target[order]
        # Rare words get numbers beyond all symbols, good for this bucket.
        symbols = len(lexicon.counts)
        context, after = _flat(table, "context").copy(), _flat(table, "after").copy()
        first, second = _flat(table, "context_word"), _flat(table, "after_word")
        words, back = np.unique(np.concatenate([first, second]), return_inverse=True)
        context[context == lexicon.rare] = symbols + back[: len(first)]
        rare = after == lexicon.rare
        after[rare] = symbols + back[len(first) :]
        single = np.zeros(len(words), np.int64)
        word, n = _flat(table, "word"), _flat(table, "n")
        if len(word):
            single[np.searchsorted(words, word)] = n
        log_p = np.concatenate([sent.value[2], lexicon.log_p_of(single)])
        # All occurrences of a rare context are here.
        own = context[learns]
        counts = np.concatenate([lexicon.counts, np.bincount(own[own >= symbols] - symbols, minlength=len(words))])
        times = single[after[rare] - symbols]
        sums = {
            "known": np.bincount(owner[rare][times > 0], minlength=len(names)),
            "base": np.bincount(owner[rare], lexicon.log_base(times), len(names)),
        }
        pair = context.astype(np.int64) << 32 | after
        del context, after, own, rare, times, back, first, second
        pairs, back = np.unique(pair, return_inverse=True)
        del pair
        count = np.bincount(back[learns], minlength=len(pairs))
        context, after = pairs >> 32, pairs & 0xFFFFFFFF
        more, lost, sizes = _evaluate(context[back], after[back], count[back], owner, len(names), counts, log_p)
        sums |= more
        kept = count > 0
        own = _context_rows(context[kept], after[kept], count[kept], log_p)
        rare = own["context"] >= symbols
        # What the weight of a rare context is made of, once the discounts are known; one never seen has weight one.
        shape = np.zeros((len(words), _SHAPE))
        at = own["context"][rare] - symbols
        for k, c in enumerate((*_PARTS, "seen", "unseen")):
            shape[at, k] = own[c][rare]
        shape[:, -1] = counts[symbols:]
        holder = np.repeat(np.arange(len(names)), sizes)
        common = lost < symbols
        far = ~common
        far[far] = counts[lost[far]] > 0
        sums["lost"] = np.bincount(holder[common], minlength=len(names))
        sums["far"] = np.bincount(holder[far], minlength=len(names))
        value = sums["seen"] + sums["unseen"]
        each = _packed(target, names, sums, value, sums["base"], lost[common], shape[lost[far] - symbols].ravel())
        # Rare contexts count together in the counts of counts.
        told = {c: np.append(own[c][~rare], own[c][rare].sum()) for c in (*_PARTS, "seen", "unseen")}
        by_context = _packed_contexts(np.append(own["context"][~rare], lexicon.rare), told)
        return _together(each, by_context)

    def settle(table: pa.Table) -> pa.Table:
        return freed(evaluated(table))

    found = stored(dealt.groupBy("bucket").applyInArrow(settle, _PACKED), "sums")
    return _combined(settled, found, lexicon, square, id)


def discounts(n: np.ndarray) -> np.ndarray:
    """Katz's Good-Turing discounts of counts 1 to CUT; ``n`` pairs were seen 1, 2, ..., CUT + 1 times."""
    r = np.arange(1, CUT + 1)
    fallback = 1 - 0.5 / r
    if (n <= 0).any():
        return fallback
    beyond = (CUT + 1) * n[CUT] / n[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        d = ((r + 1) * n[1:] / n[:-1] / r - beyond) / (1 - beyond)
    return np.where((d > 0) & (d < 1), d, fallback)


def _combined(settled: DataFrame, found: DataFrame, lexicon: Lexicon, square: np.ndarray, id: str) -> DataFrame:
    """Adds up the parts: discounts from all counts, backoff weights from all contexts, then scores."""
    contexts = found.where("target < 0").select(F.inline(F.arrays_zip("context", *_PARTS, "seen", "unseen")))
    summed = contexts.groupBy("context").agg(*(F.sum(c).alias(c) for c in [*_PARTS, "seen", "unseen"]))
    # A row for each symbol at most: bounded by TABLE_WORDS.
    table = summed.toArrow()
    log_p = lexicon.log_p()
    size = len(lexicon.counts)
    kinds = {c: np.zeros(size) for c in [*_PARTS, "seen", "unseen"]}
    at = table["context"].to_numpy()
    for c in kinds:
        kinds[c][at] = table[c].to_numpy()
    hottest = np.flatnonzero(lexicon.hot >= 0)
    x, y = np.nonzero(square)
    if len(x):
        own = _context_rows(hottest[x], hottest[y], square[x, y], log_p)
        names = own.pop("context")
        for c, v in own.items():
            kinds[c][names] += v
    told = np.arange(1, _TOLD + 1)
    d = np.append(discounts(np.array([kinds[h].sum() for h in _PARTS])), 1.0)
    kept = kinds["seen"] + sum(kinds[f"h{r}"] * r * d[r - 1] for r in told)
    left = 1 - kept / (lexicon.counts + 0.5)
    room = np.maximum(1 - kinds["unseen"], 1e-12)
    log_alpha = np.log10(np.maximum(left, 1e-300) / room)
    sent = found.sparkSession.sparkContext.broadcast((log_alpha, np.log10(d)))

    def whole(columns: dict, lost: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """log10 probabilities from the parts."""
        log_alpha, log_d = sent.value
        total = columns["seen"] + columns["unseen"]
        total = total + np.bincount(np.repeat(np.arange(len(sizes)), sizes), log_alpha[lost], len(sizes))
        for k, h in enumerate(_PARTS):
            total = total + log_d[k] * columns[h]
        return total

    def weights(far: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Sums of log10 backoff weights of rare contexts, whose parts stand in ``far``."""
        _, log_d = sent.value
        shape = far.reshape(-1, _SHAPE)
        kept = shape[:, len(_PARTS)] + shape[:, : len(_PARTS)] @ (told * 10.0**log_d)
        left = np.maximum(1 - kept / (shape[:, -1] + 0.5), 1e-300)
        value = np.log10(left / np.maximum(1 - shape[:, -2], 1e-12))
        return np.bincount(np.repeat(np.arange(len(sizes)), sizes), value, len(sizes))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lost = batch.column("lost").fill_null([])
            columns = {c: batch.column(c).to_numpy() for c in _SUMS}
            total = whole(columns, lost.flatten().to_numpy(), lost.value_lengths().to_numpy())
            names = [c for c in batch.schema.names if c not in (*_PARTS, "seen", "unseen", "lost", "context", "asked", "asking")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(total)], names=[*names, "total"])

    buckets = lexicon.buckets

    def worth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One sum for each key and task, where the parts stand: the exchange carries no parts, nor a sum a bucket."""
        held, size = [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(start, _ROWS)
                value, lost, far = (rows.column(c).flatten().to_numpy() for c in ("value", "lost", "far"))
                counts = _counts_of(rows.column("counts").flatten().to_numpy())
                total = whole({**counts, "seen": value, "unseen": 0.0}, lost, counts["lost"]) + weights(far, counts["far"])
                # Copies: a view would hold the whole batch until the sums are made.
                held.append((rows.column("key").flatten().to_numpy().copy(), counts["known"], rows.column("base").flatten().to_numpy().copy(), total))
                size += len(total)
                if size > _HELD:
                    yield _summed(held, buckets)
                    held, size = [], 0
        if held:
            yield _summed(held, buckets)

    def added(table: pa.Table) -> pa.Table:
        names, which = np.unique(_flat(table, "key"), return_inverse=True)

        def summed(name: str) -> np.ndarray:
            return np.bincount(which, _flat(table, name), len(names))

        return pa.table({"key": names, "k": summed("known").astype(np.int64), "b": summed("base"), "t": summed("total")})

    def add(table: pa.Table) -> pa.Table:
        return freed(added(table))

    kind = settled.schema["id"].dataType.simpleString()
    base = settled.mapInArrow(tidied(finish), f"key long, known long, base double, id {kind}, learns boolean, n_tokens long, total double")
    valued = found.where("target >= 0").mapInArrow(tidied(worth), "target long, key array<long>, known array<long>, base array<double>, total array<double>")
    more = valued.groupBy("target").applyInArrow(add, "key long, k long, b double, t double")
    # Equal rows share a key, and each has added its occurrences to the key's sums.
    equal = settled.groupBy("key").agg(F.count("*").alias("equal"))
    more = equal.join(more, "key", "left")
    full = base.join(more, "key")

    def part(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0)) / F.col("equal")

    return full.select(
        F.col("id").alias(id),
        F.col("learns").alias("learned"),
        "n_tokens",
        (F.col("known") + F.round(part("k")).cast("long")).alias("n_known"),
        F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + part("b")).alias("base_score"),
        (F.col("total") + part("t")).alias("score"),
    )

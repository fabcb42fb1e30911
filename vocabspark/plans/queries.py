"""One query per operator over the test tables; ``oracle.py`` states the same in SQL.

Where a table lacks what an operator acts on (camelCase, long space runs, other scripts), the
query derives a text column that has it from the whole table, the same way on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vocabspark.functions import bytelevel, splits
from vocabspark.functions.normalize import normalize
from vocabspark.operators import bpe, corpus, encode, evaluate, ids, unigram
from vocabspark.operators import inventory as inv
from vocabspark.operators import pretokenize as pt
from vocabspark.operators import vocab as vo
from vocabspark.operators.order import with_running_index
from vocabspark.plans.merge import merge_bpe, merge_unigram, trim_unigram
from vocabspark.plans.train import TrainOptions, train_vocabulary
from vocabspark.session import checkpoint, limit_batches, scratch_path, spread
from vocabspark.sources import corpus as src
from vocabspark.sources import vocab as vsrc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Sizes used on both sides.
MAX_LENGTH = 4096
TOP_PIECES = 1000
TOKEN_LENGTH = 16
TOP_TOKENS = 200
TRIM_TO = 6000
MERGE_TO = 8000
N_MERGES = 200
N_WHITE = 4
N_BUFFER = 8
VOCAB_SIZE = 1000
UNIGRAM_SIZE = 1200
SPLIT_SPEC = pt.SplitSpec(isolate_camelcase=False)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents for text work: a single input file is spread over all cores."""
    limit_batches(spark)
    return spread(documents(spark, sf).select("doc_id", "text", "lang"))


# --- sources ------------------------------------------------------------------------------


@query
def select_key(spark, sf):
    return corpus.select_key(src.read_corpus(spark, f"{sf}/pages.parquet", "html"), "html")


def _write_lines(spark, sf, name: str, kind: str) -> str:
    path = f"{scratch_path(spark, kind)}.{kind}"
    rows = table(spark, sf, name)
    if kind == "jsonl":
        rows.select("text").write.json(path)
    elif kind == "txt":
        one_line = F.regexp_replace("text", r"[\r\n]", " ")
        rows.select(one_line.alias("value")).write.text(path)
    else:
        rows.select("text").write.parquet(path)
    return path


@query
def read_jsonl(spark, sf):
    return src.read_corpus_jsonl(spark, _write_lines(spark, sf, "documents", "jsonl"))


@query
def read_text(spark, sf):
    return src.read_corpus_text(spark, _write_lines(spark, sf, "conversations", "txt"))


@query
def convert_corpus(spark, sf):
    lines = _write_lines(spark, sf, "conversations", "jsonl")
    return src.convert_corpus(spark, lines, scratch_path(spark, "converted"))


@query
def read_mixed_directory(spark, sf):
    folder = scratch_path(spark, "mixed")
    docs, talks = documents(spark, sf), table(spark, sf, "conversations")
    docs.select("text").write.parquet(f"{folder}/docs.parquet")
    docs.select("text").write.json(f"{folder}/again.jsonl")
    talks.select("text").write.parquet(f"{folder}/talks")
    talks.select("text").write.csv(f"{folder}/other.csv")
    return src.read_corpus(spark, folder)


@query
def read_named_table(spark, sf):
    """A corpus kept as a named table, by name."""
    documents(spark, sf).createOrReplaceTempView("vocabspark_corpus")
    return src.read_corpus_table(spark, "vocabspark_corpus")


@query
def read_exemplars(spark, sf):
    words = texts(spark, sf).select(F.explode(splits.split_whitespace(F.col("text"))).alias("value"))
    folder = f"{scratch_path(spark, 'exemplars')}.txt"
    words.write.text(folder)
    return vsrc.read_exemplars(spark, folder, "words")


# --- corpus operators ---------------------------------------------------------------------


@query
def corpus_profile(spark, sf):
    return corpus.corpus_profile(documents(spark, sf), ["lang"], max_length=MAX_LENGTH)


@query
def sample_prefix(spark, sf):
    rows = corpus.sample_prefix(table(spark, sf, "conversations"), 37, ["conv_id", "turn"])
    return rows.select("conv_id", "turn", "text")


@query
def sample_prefix_by_threshold(spark, sf):
    rows = corpus.sample_prefix(
        table(spark, sf, "conversations"), 37, ["conv_id", "turn"], take_ordered_rows=0
    )
    return rows.select("conv_id", "turn", "text")


@query
def sample_prefix_ties(spark, sf):
    """A key that repeats: the last conversation is cut inside, by the other columns."""
    return corpus.sample_prefix(table(spark, sf, "conversations"), 37, ["conv_id"], take_ordered_rows=0)


@query
def shuffle(spark, sf):
    return corpus.shuffle(documents(spark, sf).select("doc_id"), 42, ["doc_id"], "pos")


@query
def sample_shuffled(spark, sf):
    rows = corpus.sample_shuffled(documents(spark, sf), 37, 42, ["doc_id"], take_ordered_rows=0)
    return rows.select("doc_id", "text")


@query
def take_first(spark, sf):
    return corpus.take(table(spark, sf, "conversations").select("conv_id", "turn", "text"), 10, ["conv_id", "turn"])


@query
def filter_max_length(spark, sf):
    return corpus.filter_max_length(documents(spark, sf).select("doc_id", "text"), "text", MAX_LENGTH)


@query
def filter_blank(spark, sf):
    digits = F.regexp_replace("text", r"[^0-9 \n]", "").alias("text")
    return corpus.filter_blank(documents(spark, sf).select("doc_id", digits))


# --- normalize and split --------------------------------------------------------------------


# Composed letters and the same as a base letter with a combining mark.
DECOMPOSED = {"\u00e9": "e\u0301", "\u00fc": "u\u0308", "\u00f1": "n\u0303"}
# Latin letters and a Cyrillic, Han, Hiragana and Hangul character to put in their place.
OTHER_SCRIPTS = ("aqxz", "\u0430\u6f22\u304b\uc544")
LIGATURE = "\ufb01"


def _decomposed(text: Column) -> Column:
    for whole, parts in DECOMPOSED.items():
        text = F.replace(text, F.lit(whole), F.lit(parts))
    return text


@query
def normalize_nfc(spark, sf):
    docs = texts(spark, sf).select("doc_id", _decomposed(F.col("text")).alias("text"))
    return docs.select("doc_id", normalize(F.col("text"), "NFC").alias("text"))


@query
def normalize_nfkc(spark, sf):
    docs = texts(spark, sf).select("doc_id", F.replace("text", F.lit("fi"), F.lit(LIGATURE)).alias("text"))
    return docs.select("doc_id", normalize(F.col("text"), "NFKC").alias("text"))


def _split(spark, sf, steps: list[str], text: Column | None = None) -> DataFrame:
    docs = texts(spark, sf).select("doc_id", (F.col("text") if text is None else text).alias("text"))
    return pt.explode_pieces(docs, steps, ["doc_id"])


@query
def pt_whitespace(spark, sf):
    return _split(spark, sf, ["whitespace"])


@query
def pt_scripts(spark, sf):
    return _split(spark, sf, ["scripts"], F.translate("text", *OTHER_SCRIPTS))


@query
def pt_punct(spark, sf):
    return _split(spark, sf, ["punctuation"])


@query
def pt_digits(spark, sf):
    return _split(spark, sf, ["digits"], F.translate("text", "eo", "30"))


def _spaced(text: str = "text") -> Column:
    """Runs of 16, 17 and 5 spaces after commas, stops and colons."""
    wide = F.replace(F.col(text), F.lit(", "), F.lit("," + " " * 16))
    return F.replace(wide, F.lit(". "), F.lit("." + " " * 17))


@query
def pt_drop_longspace(spark, sf):
    return _split(spark, sf, ["longspace"], _spaced())


@query
def pt_camel(spark, sf):
    return _split(spark, sf, ["camel"], F.replace("text", F.lit(" "), F.lit("")))


@query
def pt_word_with_space(spark, sf):
    return _split(spark, sf, ["word_with_space"])


@query
def pt_bytelevel_split(spark, sf):
    return _split(spark, sf, ["byte_level"], F.replace("text", F.lit(". "), F.lit(".  ")))


@query
def split_train(spark, sf):
    spec = pt.SplitSpec(remove_longspace=True)
    return _split(spark, sf, spec.train(), _spaced())


@query
def split_inference(spark, sf):
    spec = pt.SplitSpec(remove_longspace=True)
    return _split(spark, sf, spec.inference(), _spaced())


@query
def split_without_whitespace(spark, sf):
    return _split(spark, sf, pt.SplitSpec(preserve_whitespace="no").inference())


@query
def split_byte_fallback(spark, sf):
    return _split(spark, sf, pt.SplitSpec(byte_fallback=True).inference())


@query
def byte_chars(spark, sf):
    counts = pt.count_pretokens(texts(spark, sf), ["byte_level"]).select("piece")
    shown = bytelevel.to_byte_chars(F.col("piece"))
    return counts.select("piece", shown.alias("shown")).withColumn(
        "back", bytelevel.from_byte_chars(F.col("shown"))
    )


@query
def pretoken_counts(spark, sf):
    return pt.count_pretokens(texts(spark, sf), ["byte_level"])


@query
def pretoken_counts_by_lang(spark, sf):
    return pt.count_pretokens(texts(spark, sf), ["byte_level"], ["lang"])


@query
def top_pieces_by_lang(spark, sf):
    """Flagship: filters, byte-level split, counts and the most frequent pieces per language."""
    docs = texts(spark, sf)
    rows = corpus.filter_blank(corpus.filter_max_length(docs, "text", MAX_LENGTH))
    counts = pt.count_pretokens(rows, ["byte_level"], ["lang"])
    best = W.partitionBy("lang").orderBy(F.desc("n"), "piece")
    return counts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= TOP_PIECES)


# --- inventories ----------------------------------------------------------------------------


def _with_control(text: str = "text") -> Column:
    """Control tokens in place of some words and sentence ends."""
    marked = F.replace(F.col(text), F.lit(".\n"), F.lit("<|endoftext|>"))
    marked = F.replace(marked, F.lit(" the "), F.lit("<|s|>"))
    return F.replace(marked, F.lit(" and "), F.lit("<|unused07|>"))


def _control_docs(spark, sf) -> DataFrame:
    return texts(spark, sf).select(_with_control().alias("text"))


@query
def special_tokens(spark, sf):
    return inv.token_usage(_control_docs(spark, sf), inv.special_tokens(spark))


@query
def buffer_tokens(spark, sf):
    return inv.token_usage(_control_docs(spark, sf), inv.buffer_tokens(spark))


@query
def whitespace_tokens(spark, sf):
    docs = texts(spark, sf).select(_spaced().alias("text"))
    return inv.token_usage(docs, inv.whitespace_tokens(spark, N_WHITE, "exp", single=True))


@query
def byte_alphabet(spark, sf):
    used = inv.byte_usage(texts(spark, sf))
    joined = bytelevel.byte_alphabet(spark).join(used, "byte", "left")
    return joined.select("byte", "ch", F.coalesce("n", F.lit(0)).alias("n"))


@query
def fallback_tokens(spark, sf):
    used = inv.byte_usage(table(spark, sf, "pages"), "html")
    joined = inv.fallback_tokens(spark).join(used, "byte", "left")
    return joined.select("token", "byte", "logprob", F.coalesce("n", F.lit(0)).alias("n"))


@query
def vocab_budget(spark, sf):
    white = inv.whitespace_tokens(spark, N_WHITE)
    added = inv.added_tokens(spark, N_BUFFER, byte_fallback=True)
    used = inv.char_usage(texts(spark, sf), ["lang"])
    return inv.vocab_budget(VOCAB_SIZE, white, added, used, ["lang"])


@query
def assign_roles(spark, sf):
    roles = inv.assign_roles(inv.added_tokens(spark, N_BUFFER))
    return inv.token_usage(_control_docs(spark, sf), roles)


# --- BPE and unigram counts -------------------------------------------------------------------


def _byte_counts(docs: DataFrame) -> DataFrame:
    return pt.byte_pieces(pt.count_pretokens(docs, ["byte_level"]))


@query
def bpe_pair_counts(spark, sf):
    return bpe.bpe_pair_counts(bpe.to_words(_byte_counts(texts(spark, sf))))


@query
def bpe_pair_counts_filtered(spark, sf):
    words = bpe.to_words(_byte_counts(texts(spark, sf)))
    merged = bpe.merge_pairs(F.col("word"), [("Ġ", "t"), ("e", "r")])
    return bpe.bpe_pair_counts(words.select(merged.alias("word"), "n"), 20, 3)


@query
def unigram_seed(spark, sf):
    return unigram.unigram_seed(_byte_counts(texts(spark, sf)), TOKEN_LENGTH)


# --- two vocabularies: base from the English documents, plus from all others ------------------------


@lru_cache(maxsize=8)
def side_pieces(spark, sf) -> DataFrame:
    """``(side, piece, n)``: the pieces of both sides from one scan, written once; no language is in ``plus``."""
    side = F.when(F.col("lang") == "en", "base").otherwise("plus").alias("side")
    docs = texts(spark, sf).select(side, "text")
    return checkpoint(pt.byte_pieces(pt.count_pretokens(docs, ["byte_level"], ["side"])))


def _pieces_of(spark, sf, side: str) -> DataFrame:
    """The pieces of one side, or of ``all`` documents."""
    pieces = side_pieces(spark, sf)
    if side == "all":
        return pieces.groupBy("piece").agg(F.sum("n").alias("n"))
    return pieces.where(F.col("side") == side).select("piece", "n")


@lru_cache(maxsize=8)
def side_uvocab(spark, sf, side: str) -> DataFrame:
    """Every piece of a side, scored by its share."""
    counts = _pieces_of(spark, sf, side)
    total = counts.agg(F.sum("n")).scalar()
    scored = counts.select(F.col("piece").alias("token"), F.round(F.log(F.col("n") / total), 9).alias("logprob"))
    return checkpoint(scored)


@lru_cache(maxsize=8)
def side_merges(spark, sf, side: str) -> DataFrame:
    """A merge list of one side: every substring of its pieces, made by adding its last character.

    A prefix is at least as frequent as the whole and shorter, so it stands earlier.
    """
    length = F.length("token")
    seeds = unigram.unigram_seed(_pieces_of(spark, sf, side), TOKEN_LENGTH).where(length > 1)
    ranked = with_running_index(seeds, [F.desc("n"), length, F.col("token")], "rank")
    return ranked.select(
        F.col("rank").cast("int").alias("rank"),
        F.substring("token", F.lit(1), length - 1).alias("left"),
        F.right("token", F.lit(1)).alias("right"),
        "token",
    )


@lru_cache(maxsize=8)
def side_vocab(spark, sf, side: str) -> DataFrame:
    alphabet = bytelevel.byte_alphabet(spark).select(F.col("ch").alias("token"))
    white = inv.whitespace_tokens(spark, N_WHITE)
    return ids.assign_ids(inv.special_tokens(spark), alphabet, side_merges(spark, sf, side), white)


OFFSET = len(inv.SPECIAL_TOKENS) + 256


@query
def assign_ids(spark, sf):
    return side_vocab(spark, sf, "all")


@query
def vocab_counts(spark, sf):
    return vo.vocab_counts(side_vocab(spark, sf, "all"), side_merges(spark, sf, "all"))


@query
def merge_misaligned(spark, sf):
    """The other side's merges against the base vocabulary, so that many differ."""
    return vo.merge_misaligned(side_vocab(spark, sf, "base"), side_merges(spark, sf, "plus"), OFFSET)


@query
def merge_by_token(spark, sf):
    return vo.merge_by_token(side_vocab(spark, sf, "all"), side_merges(spark, sf, "all"), OFFSET)


def _union(spark, sf) -> DataFrame:
    return vo.union_bpe(side_merges(spark, sf, "base"), side_merges(spark, sf, "plus"))


@query
def union_bpe(spark, sf):
    return _union(spark, sf)


@query
def order_union(spark, sf):
    return vo.order_union(_union(spark, sf), OFFSET)


@query
def reindex_bpe(spark, sf):
    union = vo.order_union(_union(spark, sf), OFFSET)
    return vo.reindex_bpe(side_vocab(spark, sf, "base"), union)


@query
def merge_bpe_job(spark, sf):
    """The whole merge of two BPE vocabularies: the first merges of the union, ids and whitespace numbered anew."""
    base, plus = (
        encode.Vocabulary(side_vocab(spark, sf, side), side_merges(spark, sf, side)) for side in ("base", "plus")
    )
    return merge_bpe(base, plus, MERGE_TO).tokens


@query
def budget_deficit(spark, sf):
    return vo.budget_deficit(_union(spark, sf), vo.merge_budget(VOCAB_SIZE, N_WHITE, N_BUFFER))


def _rounded(uvocab: DataFrame, digits: int = 9) -> DataFrame:
    return uvocab.withColumn("logprob", F.round("logprob", digits))


def _mean_union(spark, sf) -> DataFrame:
    """Means of scores with 9 digits have 10."""
    return _rounded(_union_unigram(spark, sf, "mean"), 10)


def _union_unigram(spark, sf, mode: str) -> DataFrame:
    return vo.union_unigram(side_uvocab(spark, sf, "base"), side_uvocab(spark, sf, "plus"), mode)


@query
def union_unigram_mean(spark, sf):
    return _mean_union(spark, sf)


@query
def union_unigram_max(spark, sf):
    return _rounded(_union_unigram(spark, sf, "max"))


@query
def union_unigram_min(spark, sf):
    return _rounded(_union_unigram(spark, sf, "min"))


@query
def top_by_score(spark, sf):
    return vo.top_by_score(_mean_union(spark, sf), TOP_TOKENS)


@query
def order_by_score(spark, sf):
    return vo.order_vocab(_mean_union(spark, sf), "score")


@query
def order_by_length(spark, sf):
    return vo.order_vocab(_mean_union(spark, sf), "length")


@query
def unigram_alp(spark, sf):
    return evaluate.unigram_alp(side_uvocab(spark, sf, "all"), VOCAB_SIZE)


def exemplars(spark, sf) -> DataFrame:
    """Letters beyond ASCII, one set per language."""
    letters = inv.char_usage(texts(spark, sf), ["lang"])
    beyond = letters.where(F.col("ch").rlike(r"^\p{L}$") & ~F.col("ch").rlike(r"^\p{ASCII}$"))
    return beyond.select(F.col("ch").alias("token"), F.col("lang").alias("set"))


def _essentials(spark, sf) -> DataFrame:
    return checkpoint(vo.essential_tokens(spark, exemplars(spark, sf)))


@query
def essential_tokens(spark, sf):
    return vo.essential_tokens(spark, exemplars(spark, sf))


@query
def add_essentials(spark, sf):
    return vo.add_essentials(side_uvocab(spark, sf, "all"), _essentials(spark, sf))


@query
def trim_vocab(spark, sf):
    filled = vo.add_essentials(side_uvocab(spark, sf, "all"), _essentials(spark, sf))
    return vo.trim_vocab(checkpoint(filled), _essentials(spark, sf), TRIM_TO)


@query
def trim_unigram_job(spark, sf):
    return _rounded(trim_unigram(side_uvocab(spark, sf, "all"), _essentials(spark, sf), TRIM_TO))


@query
def merge_unigram_job(spark, sf):
    base, plus = side_uvocab(spark, sf, "base"), side_uvocab(spark, sf, "plus")
    return _rounded(merge_unigram(base, plus, _essentials(spark, sf), "max", MERGE_TO))


@query
def intermediate_size(spark, sf):
    """Sizes of a listing in which the two sides' merge tokens repeat."""
    base = side_vocab(spark, sf, "base").select("token", "kind")
    plus = side_merges(spark, sf, "plus").select("token", F.lit("merge").alias("kind"))
    return vo.intermediate_size(base.unionByName(plus), VOCAB_SIZE)


@query
def floor_bytes(spark, sf):
    return _rounded(vo.floor_bytes(side_uvocab(spark, sf, "all")))


@query
def repair_bytes(spark, sf):
    return _rounded(vo.repair_bytes(side_uvocab(spark, sf, "all")))


@query
def rescore_essentials(spark, sf):
    filled = vo.add_essentials(side_uvocab(spark, sf, "all"), _essentials(spark, sf))
    return _rounded(vo.rescore_essentials(filled, _essentials(spark, sf)))


def _listed(spark, sf) -> DataFrame:
    """Both sides one after the other, so that shared tokens are listed twice."""
    base, plus = (side_uvocab(spark, sf, side) for side in ("base", "plus"))
    base = vo.order_vocab(base)
    plus = vo.order_vocab(plus).withColumn("pos", F.col("pos") + base.agg(F.count(F.lit(1))).scalar())
    return base.unionByName(plus)


@query
def duplicate_tokens(spark, sf):
    return vo.duplicate_tokens(_listed(spark, sf))


@query
def dedupe_vocab(spark, sf):
    return vo.dedupe_vocab(_listed(spark, sf))


@query
def exemplar_coverage(spark, sf):
    in_bytes = exemplars(spark, sf).withColumn("token", bytelevel.to_byte_chars(F.col("token")))
    return vo.exemplar_coverage(side_merges(spark, sf, "all"), in_bytes)


@query
def check_size(spark, sf):
    return vo.check_size(_listed(spark, sf), VOCAB_SIZE)


@query
def set_unk(spark, sf):
    vocab = side_vocab(spark, sf, "all")
    meta = vocab.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    return vo.set_unk(meta, vocab)


# --- training, encoding, reports --------------------------------------------------------------------


def bpe_options() -> TrainOptions:
    fixed = len(inv.SPECIAL_TOKENS) + N_BUFFER + 256
    return TrainOptions(
        vocab_size=fixed + N_MERGES, n_buffer=N_BUFFER, max_sentence_length=0, spec=SPLIT_SPEC
    )


@lru_cache(maxsize=8)
def bpe_vocabulary(spark, sf) -> encode.Vocabulary:
    return train_vocabulary(texts(spark, sf), bpe_options())


@lru_cache(maxsize=8)
def unigram_vocabulary(spark, sf) -> encode.Vocabulary:
    opts = TrainOptions(
        model="unigram", vocab_size=UNIGRAM_SIZE, n_buffer=N_BUFFER, max_token_length=8,
        max_sentence_length=0, spec=SPLIT_SPEC,
    )
    return train_vocabulary(texts(spark, sf), opts)


def bpe_merges(spark, sf, n_merges: int) -> DataFrame:
    counts = pt.byte_pieces(
        pt.count_pretokens(texts(spark, sf), SPLIT_SPEC.train(), normal_form="NFC")
    )
    return bpe.train_bpe(counts, n_merges)


@query
def train_bpe(spark, sf):
    return bpe_merges(spark, sf, N_MERGES)


@query
def train_bpe_fallback(spark, sf):
    """Training over characters, with the 256 byte tokens outside the model."""
    spec = pt.SplitSpec(isolate_camelcase=False, byte_fallback=True)
    fixed = len(inv.SPECIAL_TOKENS) + N_BUFFER + 256
    chars = inv.char_usage(texts(spark, sf)).where(F.col("ch") != "").count()
    opts = TrainOptions(vocab_size=fixed + chars + N_MERGES, n_buffer=N_BUFFER, max_sentence_length=0, spec=spec)
    vocab = train_vocabulary(texts(spark, sf), opts)
    made = vsrc.make_artifact(vocab)
    rules = vocab.merges.select("token", "rank")
    return made.tokens.join(made.added.select("token", "special"), "token", "left").join(rules, "token", "left").select(
        "token", "id", "kind", "special", "rank"
    )


@query
def component_mode(spark, sf):
    """Unigram training without any added token."""
    opts = TrainOptions(
        model="unigram", vocab_size=UNIGRAM_SIZE, max_token_length=8, max_sentence_length=0, component_mode=True, spec=SPLIT_SPEC
    )
    tokens = train_vocabulary(texts(spark, sf), opts).tokens
    return tokens.select("token", "id", "kind", F.round("logprob", 6).alias("logprob"))


@query
def train_unigram(spark, sf):
    tokens = unigram_vocabulary(spark, sf).tokens
    return tokens.where("kind = 'token'").select("token", "id", F.round("logprob", 6).alias("logprob"))


def _encoded(spark, sf, vocab=bpe_vocabulary) -> DataFrame:
    return encode.encode(texts(spark, sf), vocab(spark, sf))


def _encoded_pieces(spark, sf) -> DataFrame:
    return encode.encode_pieces(texts(spark, sf), bpe_vocabulary(spark, sf), by=["lang"])


def _ids_text(encoded: DataFrame) -> DataFrame:
    """The ids of each text in one string."""
    return encoded.select("doc_id", F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"))


@query
def encode_bpe(spark, sf):
    return _ids_text(_encoded(spark, sf))


@query
def encode_bpe_by_join(spark, sf):
    docs = texts(spark, sf)
    return _ids_text(encode.encode(docs, bpe_vocabulary(spark, sf), max_broadcast_rows=0))


@query
def encode_unigram(spark, sf):
    return _ids_text(_encoded(spark, sf, unigram_vocabulary))


@query
def encode_dropout(spark, sf):
    docs = texts(spark, sf)
    return _ids_text(encode.encode(docs, bpe_vocabulary(spark, sf), dropout=0.1, seed=7))


@query
def decode(spark, sf):
    return encode.decode(_encoded(spark, sf), bpe_vocabulary(spark, sf)).select("doc_id", "decoded")


@query
def decode_by_join(spark, sf):
    vocab = bpe_vocabulary(spark, sf)
    return encode.decode(_encoded(spark, sf), vocab, max_broadcast_rows=0).select("doc_id", "decoded")


@query
def decode_unigram(spark, sf):
    vocab = unigram_vocabulary(spark, sf)
    return encode.decode(_encoded(spark, sf, unigram_vocabulary), vocab).select("doc_id", "decoded")


@query
def decode_dropout(spark, sf):
    vocab = bpe_vocabulary(spark, sf)
    encoded = encode.encode(texts(spark, sf), vocab, dropout=0.1, seed=7)
    return encode.decode(encoded, vocab).select("doc_id", "decoded")


@query
def vocab_roundtrip(spark, sf):
    return encode.vocab_roundtrip(bpe_vocabulary(spark, sf)).select("id", "token", "decoded", "same")


@query
def vocab_artifact(spark, sf):
    """Write the trained vocabulary, read it back and list its tokens with their added role."""
    made = vsrc.write_vocab(bpe_vocabulary(spark, sf), scratch_path(spark, "vocab"))
    return made.tokens.join(made.added.select("token", "special"), "token", "left")


@query
def vocab_json(spark, sf):
    """Write the trained vocabulary as a JSON document in parts and read it back."""
    path = scratch_path(spark, "vocab-json")
    vsrc.write_vocab_json(vsrc.make_artifact(bpe_vocabulary(spark, sf)), path)
    back = vsrc.read_vocab_json_parts(spark, path)
    return back.tokens.join(back.merges.select("token", "rank"), "token", "left").select("token", "id", "kind", "rank")


@query
def invertibility(spark, sf):
    return evaluate.invertibility(_encoded(spark, sf), bpe_vocabulary(spark, sf), ["lang"])


@query
def length_stats(spark, sf):
    return evaluate.length_stats(_encoded(spark, sf), ["lang"])


@query
def token_frequency(spark, sf):
    used = evaluate.token_frequency(_encoded_pieces(spark, sf), ["lang"], "n")
    tokens = bpe_vocabulary(spark, sf).tokens
    return used.join(tokens.select("id", "token"), "id").select("lang", "token", "n")


@query
def token_decode_table(spark, sf):
    return evaluate.token_decode_table(bpe_vocabulary(spark, sf))


@query
def fallback_portion(spark, sf):
    vocab = bpe_vocabulary(spark, sf)
    return evaluate.fallback_portion(_encoded_pieces(spark, sf), vocab, ["lang"], "n")


@query
def reconstruction(spark, sf):
    return evaluate.reconstruction(_encoded(spark, sf), bpe_vocabulary(spark, sf))

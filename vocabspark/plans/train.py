"""The training job: corpus -> sample and filters -> pieces -> vocabulary."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabspark.functions.bytelevel import byte_alphabet
from vocabspark.operators import inventory as inv
from vocabspark.operators.bpe import train_bpe
from vocabspark.operators.corpus import filter_blank, filter_max_length, sample_shuffled
from vocabspark.operators.encode import Vocabulary
from vocabspark.operators.ids import assign_ids, assign_unigram_ids
from vocabspark.operators.pretokenize import SplitSpec, byte_pieces, chars, count_pretokens
from vocabspark.operators.unigram import train_unigram
from vocabspark.operators.vocab import add_essentials, trim_vocab
from vocabspark.session import checkpoint


@dataclass(frozen=True)
class TrainOptions:
    """Options of a training run; the defaults are those of the two-model trainer."""

    model: str = "bpe"
    vocab_size: int = 50_257
    key: str = "text"
    order_by: tuple[str, ...] = ("doc_id",)
    sample_percent: float = 100
    shuffle_seed: int = 0
    max_sentence_length: int = 4096
    max_token_length: int = 16
    min_frequency: int = 0
    n_buffer: int = 64
    whitespace_reservation: int = 0
    whitespace_mode: str = "linear"
    single_whitespace: bool = False
    component_mode: bool = False
    spec: SplitSpec = field(default_factory=SplitSpec)

    def __post_init__(self):
        if self.model not in ("bpe", "unigram"):
            raise ValueError(f"unknown model {self.model!r}")
        if self.component_mode and self.model == "bpe":
            raise ValueError("component mode applies to unigram only")


def training_rows(corpus: DataFrame, opts: TrainOptions) -> DataFrame:
    """Sample first, then the length filter, then the blank filter."""
    sampled = sample_shuffled(corpus, opts.sample_percent, opts.shuffle_seed, opts.order_by)
    return filter_blank(filter_max_length(sampled, opts.key, opts.max_sentence_length), opts.key)


def training_pieces(corpus: DataFrame, opts: TrainOptions) -> DataFrame:
    """Distinct pieces with counts, in the byte alphabet unless in fallback mode."""
    spec = opts.spec
    rows = training_rows(corpus, opts)
    counts = count_pretokens(rows, spec.train(), key=opts.key, normal_form=spec.normal_form)
    return counts if spec.byte_fallback else byte_pieces(counts)


def start_alphabet(spark: SparkSession, counts: DataFrame, opts: TrainOptions) -> DataFrame:
    """All 256 byte characters, or the characters the corpus uses in fallback mode."""
    if not opts.spec.byte_fallback:
        return byte_alphabet(spark).select(F.col("ch").alias("token"))
    return counts.select(F.explode(chars(F.col("piece"))).alias("token")).distinct()


def train_vocabulary(corpus: DataFrame, opts: TrainOptions = TrainOptions()) -> Vocabulary:
    """Learn a vocabulary from a corpus table."""
    spark, spec = corpus.sparkSession, opts.spec
    counts = checkpoint(training_pieces(corpus, opts))
    white = inv.whitespace_tokens(
        spark, opts.whitespace_reservation, opts.whitespace_mode, opts.single_whitespace
    )
    added = inv.added_tokens(spark, opts.n_buffer, spec.byte_fallback, opts.component_mode)
    alphabet = start_alphabet(spark, counts, opts)
    if opts.model == "bpe":
        budget = inv.vocab_budget(opts.vocab_size, white, added, alphabet).first().n_learned
        merges = train_bpe(counts, max(budget, 0), opts.min_frequency, opts.max_token_length)
        tokens = checkpoint(assign_ids(added, alphabet, merges, white))
        return Vocabulary(tokens, merges.drop("n"), spec)
    sized = inv.vocab_budget(opts.vocab_size, white, added, alphabet).first()
    budget = sized.trainer_size - sized.n_added
    longest = opts.max_token_length if opts.max_token_length > 0 else 16
    learned = train_unigram(counts, budget, longest)
    if not opts.component_mode and not spec.byte_fallback:
        learned = with_alphabet(learned, alphabet, budget)
    return Vocabulary(checkpoint(assign_unigram_ids(added, learned, white)), None, spec)


def with_alphabet(learned: DataFrame, alphabet: DataFrame, budget: int) -> DataFrame:
    """Make room for the whole alphabet: missing characters replace the unlikeliest tokens."""
    from vocabspark.operators.vocab import add_essentials, trim_vocab

    return trim_vocab(add_essentials(learned, alphabet), alphabet, budget)

"""Vocabulary artifacts: a directory of Parquet tables, JSON import and export, exemplars."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocabspark.functions.patterns import WS
from vocabspark.operators.encode import FALLBACK, Vocabulary
from vocabspark.operators.inventory import fallback_tokens
from vocabspark.operators.order import with_running_index
from vocabspark.operators.pretokenize import SplitSpec
from vocabspark.operators.vocab import set_unk
from vocabspark.session import fits_broadcast

MODELS = ("bpe", "unigram")


@dataclass(frozen=True)
class Artifact:
    """Tables of a finished vocabulary. ``merges`` is None for a unigram model."""

    tokens: DataFrame
    added: DataFrame
    meta: DataFrame
    merges: DataFrame | None = None

    def vocabulary(self) -> Vocabulary:
        row = self.meta.first()
        spec = SplitSpec(
            row.normal_form, row.preserve_whitespace, row.remove_longspace,
            row.isolate_camelcase, row.byte_fallback,
        )
        return Vocabulary(self.tokens, self.merges, spec)


def make_artifact(vocab: Vocabulary) -> Artifact:
    """Added tokens and one-row meta table of a vocabulary.

    Fallback tokens are added tokens that are not special.
    """
    spark = vocab.tokens.sparkSession
    fallback = F.broadcast(fallback_tokens(spark).select("token", F.lit(True).alias("is_fallback")))
    added = vocab.tokens.where(F.col("kind").isin("special", "whitespace")).join(fallback, "token", "left")
    special = (F.col("kind") == "special") & ~F.coalesce("is_fallback", F.lit(False))
    added = added.select("token", "id", special.alias("special"))
    spec = vocab.spec
    meta = spark.createDataFrame(
        [(vocab.model, spec.normal_form, spec.preserve_whitespace, spec.remove_longspace,
          spec.isolate_camelcase, spec.byte_fallback)],
        "model string, normal_form string, preserve_whitespace string, remove_longspace boolean,"
        "isolate_camelcase boolean, byte_fallback boolean",
    )
    return Artifact(vocab.tokens, added, set_unk(meta, vocab.tokens), vocab.merges)


def write_vocab(vocab: Vocabulary, path: str) -> Artifact:
    """Write the tables below ``path``, read them back and check that nothing is missing."""
    made = make_artifact(vocab)
    tables = {"tokens": made.tokens, "added": made.added, "meta": made.meta}
    if made.merges is not None:
        tables["merges"] = made.merges
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")
    back = read_vocab(vocab.tokens.sparkSession, path)
    for name, table in tables.items():
        wrote, read = table.count(), getattr(back, name).count()
        if wrote != read:
            raise ValueError(f"{path}/{name}: wrote {wrote} rows, read back {read}")
    return back


def read_vocab(spark: SparkSession, path: str) -> Artifact:
    """Read an artifact written by :func:`write_vocab`."""
    meta = spark.read.parquet(f"{path}/meta")
    model = meta.first().model
    if model not in MODELS:
        raise ValueError(f"model is {model!r}; expected one of {MODELS}")
    merges = spark.read.parquet(f"{path}/merges") if model == "bpe" else None
    tokens, added = (spark.read.parquet(f"{path}/{name}") for name in ("tokens", "added"))
    return Artifact(tokens, added, meta, merges)


_ADDED_JSON = "struct<id:int,content:string,special:boolean>"
_FLAGS = "type:string,byte_fallback:boolean,unk_id:int"
_VOCAB_JSON = {"bpe": "map<string,int>", "unigram": "array<array<string>>"}


def read_vocab_json(spark: SparkSession, path: str, spec: SplitSpec = SplitSpec()) -> Vocabulary:
    """Import a vocabulary kept as one JSON file (model vocabulary, merges, added tokens).

    Such a file is one document of at most a few hundred thousand tokens. Its ``byte_fallback`` flag, if it has one, goes
    before that of ``spec``.
    """
    def document(model: str) -> DataFrame:
        schema = f"added_tokens array<{_ADDED_JSON}>, model struct<{_FLAGS},{model}>"
        return spark.read.schema(schema).json(path, multiLine=True)

    head = document("merges:array<string>").first().model
    model = _known_model(head.type)
    doc = document(f"vocab:{_VOCAB_JSON[model]},merges:array<string>")
    added = doc.select(F.inline("added_tokens"))
    if model == "bpe":
        listed = doc.select(F.explode("model.vocab").alias("token", "id"))
        rules = doc.select(F.posexplode("model.merges").alias("rank", "rule"))
    else:
        listed, rules = _scored(doc.select(F.posexplode("model.vocab").alias("id", "entry"))), None
    return _imported(added, listed, rules, _with_flag(spec, head.byte_fallback))


def _known_model(name: str | None) -> str:
    model = (name or "").lower()
    if model not in MODELS:
        raise ValueError(f"model type is {model!r}; expected one of {MODELS}")
    return model


def _with_flag(spec: SplitSpec, byte_fallback: bool | None) -> SplitSpec:
    return spec if byte_fallback is None else replace(spec, byte_fallback=byte_fallback)


def _scored(entries: DataFrame) -> DataFrame:
    token, score = F.get("entry", F.lit(0)), F.get("entry", F.lit(1))
    return entries.select(token.alias("token"), "id", score.cast("double").alias("logprob"))


def _imported(added: DataFrame, listed: DataFrame, rules: DataFrame | None, spec: SplitSpec) -> Vocabulary:
    """A vocabulary from ``added(id, content, special)``, ``listed(token, id[, logprob])`` and ``rules(rank, rule)``."""
    fallback = F.col("content").rlike(FALLBACK) & F.lit(spec.byte_fallback)
    added = added.select(
        F.col("content").alias("token"),
        F.col("id").alias("added_id"),
        F.when(F.col("special") | fallback, "special").otherwise("whitespace").alias("added_kind"),
    )
    joined = listed.join(added, "token", "full_outer")
    learned, merges, score = F.lit("token"), None, ["logprob"]
    if rules is not None:
        # ``l r``, or ``["l","r"]`` where tokens may hold spaces.
        pair = F.from_json("rule", "array<string>")
        pair = F.when(F.col("rule").startswith('["') & (F.size(pair) == 2), pair)
        sides = rules.select("rank", F.coalesce(pair, F.split("rule", " ", 2)).alias("sides"))
        left, right = F.get("sides", F.lit(0)), F.get("sides", F.lit(1))
        merges = sides.select("rank", left.alias("left"), right.alias("right"), F.array_join("sides", "").alias("token"))
        made = merges.select("token").distinct().withColumn("merged", F.lit(True))
        joined = joined.join(made, "token", "left")
        learned, score = F.when(F.col("merged"), "merge").otherwise("alphabet"), []
    kind = F.coalesce(F.col("added_kind"), learned)
    tokens = joined.select(
        "token", F.coalesce("id", "added_id").alias("id"), kind.alias("kind"), *score
    )
    return Vocabulary(tokens, merges, spec)


def _document_lines(artifact: Artifact) -> DataFrame:
    """``(section, at, value)``: the lines of the artifact's JSON document, one token or merge a line.

    Each line is complete JSON but for the comma before it.
    """
    spark, meta = artifact.tokens.sparkSession, artifact.meta.first()
    unigram = meta.model == "unigram"
    flags = {"type": meta.model, "byte_fallback": meta.byte_fallback, "unk_id": meta.unk_id}
    start, end = ("[", "]") if unigram else ("{", "}")
    fixed = {
        0: '{"added_tokens":[',
        2: f'],"model":{json.dumps(flags)[:-1]},"vocab":{start}',
        4: f"{end}}}}}" if unigram else f'{end},"merges":[',
        **({} if unigram else {6: "]}}"}),
    }
    lines = spark.createDataFrame([(k, 0, v) for k, v in fixed.items()], "section int, at long, value string")

    def quoted(text: Column) -> Column:
        inside = F.to_json(F.array(text))
        return F.substring(inside, F.lit(2), F.length(inside) - 2)

    def entries(section: int, table: DataFrame, at: str, value: Column) -> DataFrame:
        first = table.agg(F.min(at)).scalar()
        comma = F.when(F.col(at) == first, "").otherwise(",")
        return table.select(F.lit(section).alias("section"), F.col(at).cast("long").alias("at"), F.concat(comma, value).alias("value"))

    content = F.to_json(F.struct("id", F.col("token").alias("content"), "special"))
    lines = lines.unionByName(entries(1, artifact.added, "id", content))
    if unigram:
        scored = artifact.tokens.where(F.col("logprob").isNotNull())
        pair = F.concat(F.lit("["), quoted(F.col("token")), F.lit(","), F.col("logprob").cast("string"), F.lit("]"))
        return lines.unionByName(entries(3, scored, "id", pair))
    own = F.concat(quoted(F.col("token")), F.lit(":"), F.col("id").cast("string"))
    lines = lines.unionByName(entries(3, artifact.tokens, "id", own))
    rule = F.to_json(F.array("left", "right")) if meta.byte_fallback else quoted(F.concat_ws(" ", "left", "right"))
    return lines.unionByName(entries(5, artifact.merges, "rank", rule))


def write_vocab_json(artifact: Artifact, path: str) -> None:
    """Write the artifact as one JSON document in parts: the part files, one after the other, are the document.

    Written and read by as many tasks as it has parts, so that a vocabulary of any size stays out of a single row.
    """
    lines = _document_lines(artifact)
    lines.orderBy("section", "at").select("value").write.text(path)


def read_vocab_json_parts(spark: SparkSession, path: str, spec: SplitSpec = SplitSpec()) -> Vocabulary:
    """Read a document written by :func:`write_vocab_json`, line by line."""
    lines = spark.read.text(path).select(
        F.regexp_replace("value", "^,", "").alias("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    value = F.col("value")
    head = lines.where(value.startswith('],"model":')).first().value
    flags = json.loads(re.search(r'"model":(\{.*),"vocab":.$', head)[1] + "}")
    model = _known_model(flags["type"])
    added = lines.where(value.startswith('{"id":')).select(F.from_json("value", _ADDED_JSON).alias("a")).select("a.*")
    in_order = ["file", "block", "line"]
    if model == "unigram":
        entries = lines.where(value.startswith("[")).select(F.from_json("value", "array<string>").alias("entry"), *in_order)
        listed, rules = _scored(with_running_index(entries, in_order, "id").withColumn("id", F.col("id").cast("int"))), None
    else:
        text = value.rlike(r'^"(?:[^"\\]|\\.)*"$')
        own = F.from_json(F.concat(F.lit("{"), value, F.lit("}")), "map<string,int>")
        listed = lines.where(value.startswith('"') & ~text).select(F.explode(own).alias("token", "id"))
        rule = F.when(text, F.get(F.from_json(F.concat(F.lit("["), value, F.lit("]")), "array<string>"), F.lit(0)))
        rules = lines.where(text | value.startswith("[")).select(F.coalesce(rule, value).alias("rule"), *in_order)
        rules = with_running_index(rules, in_order, "rank")
        rules = rules.select(F.col("rank").cast("int").alias("rank"), "rule")
    return _imported(added, listed, rules, _with_flag(spec, flags["byte_fallback"]))


def vocab_json(artifact: Artifact) -> DataFrame:
    """The artifact as one JSON string, in id and rank order, for a vocabulary that fits one row.

    :func:`write_vocab_json` is the form for large ones.
    """
    if not fits_broadcast(artifact.tokens):
        raise ValueError("too many tokens for one JSON row; use write_vocab_json")
    lines = F.array_sort(F.collect_list(F.struct("section", "at", "value")))
    text = F.array_join(F.transform(lines, lambda x: x["value"]), "\n")
    return _document_lines(artifact).agg(text.alias("json"))


def read_exemplars(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``(token, set)`` from a JSON array (``.json``, one document) or whitespace-separated text, read by line."""
    if path.endswith(".json"):
        tokens = F.from_json("value", "array<string>")
        lines = spark.read.text(path, wholetext=True)
    else:
        tokens = F.filter(F.split("value", f"[{WS}]+"), lambda t: t != "")
        lines = spark.read.text(path)
    return lines.select(F.explode(tokens).alias("token"), F.lit(name).alias("set")).distinct()

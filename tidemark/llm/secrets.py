"""Secrets in texts: candidate strings, judged by a random forest that removes false positives. Built-in functions only.

A candidate is a run of characters of the usual alphabets of keys: of 8 or more if a name such as token or password is assigned
to it, else of 16 or more with a digit, or of 24 or more with small and capital letters. It may follow '=' as in
NAME=value; '=' belongs to it only at the end, as padding that no further value follows. The forest sees its
length, the classes of its characters and how often they change, how usual its character pairs are among secrets, how
much of it dictionary words cover, words of the document's path, and the words beside it. It learns from labelled
findings (value, before, after, path, label); the weights of character pairs (a number for each two of 128 characters)
and the dictionary (WORDS words at most) come from them as well.
"""

from __future__ import annotations

import json
import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.helpers import cut, free_names, text_of

_NAMED = r"(?i:secret|token|passwd|password|api.?key|access.?key|private.?key|auth|credential)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"
#: Dear conditions come last: a run begins, is long enough, something is assigned to it, and that has a telling name.
CANDIDATE = (
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{8})"
    rf"(?:[A-Za-z0-9+/_-]{{16,}}+|(?<=[=:]\s{{0,3}}[\"']?)(?<={_NAMED})[A-Za-z0-9+/_-]{{8,}}+)(?:={{1,2}}(?![A-Za-z0-9+/_=-]))?"
)
#: A candidate under no name that holds no digit is at least so long, and holds small and capital letters.
WITHOUT_DIGIT = 24
CONTEXT = 48
#: Parts of a text whose lengths are summed together.
GROUP = 256
MARK = "\x01"
REDACTED = "[REDACTED]"
TREES, DEPTH = 15, 5
WORDS = 1000
#: Documents whose words surround the constructed findings, at most.
TRAINING_DOCUMENTS = 400

_SECRET_NAMES = r"(?i)(secret|token|passw|api.?key|access.?key|private.?key|auth|bearer|credential)"
_HARMLESS_NAMES = r"(?i)(commit|revision|checksum|digest|sha-?\d|md5|uuid|guid|etag|example|sample|dummy|placeholder|build|isbn|order)"
_HARMLESS_PATHS = r"(?i)(test|example|sample|doc|fixture|mock)"
_FEATURES = [
    "length", "digits", "upper", "symbols", "distinct", "changes", "hexadecimal", "pairs", "covered", "harmless_path",
    "path_parts", "secret_name", "harmless_name", "assigned", "quoted",
]


def findings(docs: DataFrame, path_column: str = "source") -> DataFrame:
    """(doc_id, text_hash, path, start, value, before, after) of every candidate; start counts characters from 0.

    Null and empty texts have none. doc_id may be null or repeated. A control character 1 in a text counts as a space.
    """
    path = F.col(path_column).cast("string") if path_column in docs.columns else F.lit(None).cast("string")
    text = F.translate(text_of(), MARK, " ")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), path.alias("path"),
        text.alias("text"),
    ).filter(F.col("text").rlike(CANDIDATE))
    parts = rows.select(
        "doc_id", "text_hash", "path",
        F.split(F.regexp_replace("text", f"({CANDIDATE})", f"{MARK}$1{MARK}"), MARK, -1).alias("parts"),
    )
    # Where a part begins: the lengths of the groups of parts before its own, and of the parts before it in its group. An array
    # that grows part by part would be copied each time.
    total = lambda lengths: F.aggregate(lengths, F.lit(0), lambda n, x: n + x)
    lengths = F.transform("parts", F.length)
    groups = F.transform(F.sequence(F.lit(0), F.floor(F.size("parts") / GROUP).cast("int")), lambda g: total(F.slice("lengths", g * GROUP + 1, F.lit(GROUP))))
    bases = F.aggregate("groups", F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
    group = lambda k: F.floor(k / GROUP).cast("int")
    start = lambda k: F.get("bases", group(k)) + total(F.slice("lengths", group(k) * GROUP + 1, k - group(k) * GROUP))
    # What stands before a candidate may be one itself, such as a long name; three with what is between them fill the context.
    places = F.sequence(F.lit(1), F.size("parts") - 2, F.lit(2))
    at = lambda name, k: F.get(name, k)
    found = F.transform(
        places,
        lambda k: F.struct(
            start(k).alias("start"),
            at("parts", k).alias("value"),
            F.right(F.array_join(F.slice("parts", F.greatest(k - 5, F.lit(1)), F.least(k, F.lit(6))), ""), F.lit(CONTEXT)).alias("before"),
            F.left(at("parts", k + 1), F.lit(CONTEXT)).alias("after"),
        ),
    )
    placed = parts.withColumn("lengths", lengths).withColumn("groups", groups).withColumn("bases", bases)
    return placed.select("doc_id", "text_hash", "path", F.inline(found)).filter(
        F.col("value").rlike("[0-9]") | ((F.length("value") >= WITHOUT_DIGIT) & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]")) | F.col("before").rlike(f"{_NAMED}$")
    )


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


class SecretModel:
    """The forest, with the pair weights and the dictionary that its features need."""

    def __init__(self, forest: RandomForestClassificationModel, pairs: list[float], words: list[str]):
        self.forest, self.pairs, self.words = forest, pairs, words

    def judge(self, found: DataFrame, threshold: float = 0.5) -> DataFrame:
        """`found` with probability (of a secret) and secret (whether it reaches the threshold)."""
        columns = [c for c in found.columns if c not in ("probability", "secret")]
        scored = self.forest.transform(_assembled(_with_features(found, self.pairs, self.words)))
        likely = F.get(vector_to_array("forest_probability"), 1)
        return scored.select(*columns, F.coalesce(likely, F.lit(0.0)).alias("probability")).withColumn(
            "secret", F.col("probability") >= threshold
        )


def _pairs_of(value: Column) -> Column:
    """Pairs of neighbouring characters as numbers; all digits count as 0."""
    flat = F.regexp_replace(value, "[0-9]", "0")
    code = lambda k: F.ascii(F.substring(flat, k, 1)) % 128
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(flat) - 1, F.lit(1))), lambda k: code(k) * 128 + code(k + 1))


def _with_features(found: DataFrame, pairs: list[float], words: list[str]) -> DataFrame:
    value, before = F.col("value"), F.coalesce(F.col("before"), F.lit(""))
    after, path = F.coalesce(F.col("after"), F.lit("")), F.coalesce(F.col("path"), F.lit(""))
    weights = F.from_json(F.lit(json.dumps(pairs)), "array<double>")
    known = F.from_json(F.lit(json.dumps(words)), "array<string>")
    runs = F.regexp_extract_all(F.lower(value), F.lit("([a-z]{3,})"), 1)
    covered = F.aggregate(
        F.filter(runs, lambda r: F.array_contains(known, r)), F.lit(0), lambda n, r: n + F.length(r)
    )
    usual = F.aggregate(
        _pairs_of(value), F.lit(0.0), lambda n, p: n + F.get(weights, p)
    )
    changes = F.regexp_count(value, F.lit("(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])"))
    made = {
        "length": F.length(value),
        "digits": _share(value, "[0-9]"),
        "upper": _share(value, "[A-Z]"),
        "symbols": _share(value, "[+/_=-]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / F.length(value),
        "changes": changes / F.length(value),
        "hexadecimal": value.rlike("^([0-9a-f]+|[0-9A-F]+)$"),
        "pairs": usual / F.greatest(F.length(value) - 1, F.lit(1)),
        "covered": covered / F.length(value),
        "harmless_path": path.rlike(_HARMLESS_PATHS),
        "path_parts": F.regexp_count(path, F.lit("/")),
        "secret_name": F.right(before, F.lit(24)).rlike(_SECRET_NAMES),
        "harmless_name": F.right(before, F.lit(24)).rlike(_HARMLESS_NAMES),
        "assigned": before.rlike("[=:]\\s*[\"']?$"),
        "quoted": before.rlike("[\"']$") & after.rlike("^[\"']"),
    }
    return found.withColumns({f"forest_{k}": F.coalesce(c.cast("double"), F.lit(0.0)) for k, c in made.items()})


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"forest_{c}" for c in _FEATURES], outputCol="forest_features").transform(df)


def train_secrets(labelled: DataFrame, seed: int = 5) -> SecretModel:
    """Learns from (value, before, after, path, label 0 or 1), which must hold both labels."""
    labelled = cut(labelled.filter("value is not null and label in (0, 1)"))
    counted = labelled.select("label", F.explode(_pairs_of(F.col("value"))).alias("pair")).groupBy("pair").agg(
        F.sum("label").alias("high"), F.sum(1 - F.col("label")).alias("low")
    )
    rows = counted.collect()  # a row for each pair at most
    high, low = sum(r["high"] for r in rows) + len(rows), sum(r["low"] for r in rows) + len(rows)
    pairs = [0.0] * (128 * 128)
    for r in rows:
        pairs[r["pair"]] = math.log((r["high"] + 1) / high) - math.log((r["low"] + 1) / low)
    beside = F.explode(F.regexp_extract_all(F.lower(F.concat_ws(" ", "before", "after")), F.lit("([a-z]{4,})"), 1))
    counts = labelled.select(beside.alias("word")).groupBy("word").count().filter("count > 1")
    words = [r["word"] for r in counts.orderBy(F.desc("count"), "word").limit(WORDS).collect()]
    forest = RandomForestClassifier(
        featuresCol="forest_features", labelCol="forest_label", probabilityCol="forest_probability",
        rawPredictionCol="forest_raw", predictionCol="forest_prediction", numTrees=TREES, maxDepth=DEPTH, seed=seed,
    )
    ready = _assembled(_with_features(labelled, pairs, words)).withColumn("forest_label", F.col("label").cast("double"))
    return SecretModel(forest.fit(ready.select("forest_features", "forest_label")), pairs, words)


def constructed_findings(docs: DataFrame, most: int = TRAINING_DOCUMENTS) -> DataFrame:
    """Labelled findings set between words of documents: keys under names that tell secrets, and look-alikes.

    Of the `most` documents whose ids have the smallest hashes (those with the least texts if ids repeat). Keys are random
    strings in hexadecimal, Base64 and mixed alphabets; look-alikes are digests, revisions and UUIDs under their usual
    names, names of words and numbers, and the placeholders that manuals use.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    ids = F.broadcast(ids.orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id").limit(most))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(ids, "doc_id")
    words = texts.groupBy("doc_id").agg(F.min("text").alias("text")).select(
        "doc_id", F.slice(F.regexp_extract_all(F.substring("text", 1, 2000), F.lit("(\\p{L}{2,})"), 1), 1, 12).alias("w")
    )
    word = lambda k: F.coalesce(F.get("w", F.lit(k)), F.lit("x"))
    digest = F.sha2(F.concat(F.lit("key"), F.col("doc_id").cast("string")), 256)
    other = F.sha2(F.concat(F.lit("other"), F.col("doc_id").cast("string")), 512)
    coded = F.regexp_replace(F.base64(F.unhex(other)), "\\s", "")
    mixed = F.translate(coded, "+/=", "Zq7")
    uuid = F.concat_ws("-", *(F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    joined = F.concat_ws("_", F.lower(word(4)), F.lower(word(5)), F.lower(word(6)), F.pmod("doc_id", F.lit(97)).cast("string"), F.lit("v20240101"))
    quote, colon, bare = ('"', '"', " = "), ("'", "'", ": "), ("", "", "=")
    kinds = [
        (1, "token", F.substring(digest, 1, 40), quote), (1, "api_key", F.substring(digest, 1, 32), quote),
        (1, "secret", coded, colon), (1, "password", F.substring(mixed, 1, 20), quote),
        (1, "access_token", F.substring(mixed, 1, 36), bare), (1, "Authorization: Bearer ", F.substring(mixed, 20, 48), ("", "", "")),
        (1, "private_key", F.substring(coded, 1, 64), quote), (1, "", F.concat(F.lit("AKIA"), F.upper(F.substring(mixed, 8, 16))), quote),
        (1, "password", F.substring(mixed, 30, 10), quote), (1, "passwd", F.translate(F.substring(mixed, 44, 12), "0123456789", "gHkZqWxYvB"), bare),
        (0, "password", F.lit("changeme"), quote), (0, "token", F.lower(F.concat(word(4), word(5), word(6))), bare),
        (0, "", F.lower(F.concat(word(4), word(5), word(6), word(7), word(8))), ("", "", "")),
        (0, "commit ", F.substring(digest, 1, 40), ("", "", "")), (0, "sha256", digest, colon),
        (0, "checksum", F.substring(digest, 1, 32), quote), (0, "uuid", uuid, quote), (0, "", uuid, ("", "", "")),
        (0, "", joined, ("", "", "")), (0, "token", F.lit("your_token_here_0000000000"), quote),
        (0, "password", F.lit("XXXXXXXXXXXXXXXX1234"), quote), (0, "api_key", F.concat(F.lit("example_key_"), F.pmod("doc_id", F.lit(9)).cast("string"), F.lit("1234567890")), colon),
        (0, "order ", F.lpad(F.pmod(F.xxhash64("doc_id"), F.lit(10**18)).cast("string"), 20, "0"), ("", "", "")),
    ]
    rows = [
        F.struct(
            F.lit(label).alias("label"), value.alias("value"),
            F.concat(word(0), F.lit(" "), word(1), F.lit(f" {name}{equals if name and not name.endswith(' ') else ''}{opening}")).alias("before"),
            F.concat(F.lit(f"{closing} "), word(2), F.lit(" "), word(3)).alias("after"),
        )
        for label, name, value, (opening, closing, equals) in kinds
    ]
    path = F.when(F.pmod("doc_id", F.lit(7)) == 0, "tests/data.txt").otherwise("src/data.txt")
    return words.select(path.alias("path"), F.inline(F.array(*rows)))


def redact(docs: DataFrame, model: SecretModel, path_column: str = "source") -> DataFrame:
    """The rows of `docs`, all columns; in `text`, each value that is judged a secret is REDACTED. n_chars, if there is
    such a column, follows the text where that has changed. Texts without candidates are not moved."""
    judged = model.judge(findings(docs, path_column)).filter("secret")
    longest_first = F.transform(
        F.array_sort(F.collect_set(F.struct(F.negative(F.length("value")).alias("n"), F.col("value").alias("v")))), lambda x: x["v"]
    )
    names = docs.columns
    own_id, own_hash, own_values = free_names(names, "_id", "_hash", "_values")
    values = judged.groupBy(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_hash)).agg(longest_first.alias(own_values))
    some = text_of().rlike(CANDIDATE)
    key = (F.col("doc_id").cast("long").eqNullSafe(F.col(own_id))) & (F.xxhash64(text_of()) == F.col(own_hash))
    cleaned = F.aggregate(own_values, F.col("text").cast("string"), lambda t, v: F.replace(t, v, F.lit(REDACTED)))
    joined = docs.filter(some).join(values, key, "left").withColumn("text", F.when(F.col(own_values).isNull(), F.col("text").cast("string")).otherwise(cleaned))
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        joined = joined.withColumn("n_chars", F.when(F.col(own_values).isNull(), F.col("n_chars")).otherwise(F.char_length("text")).cast(kind))
    return docs.filter(~some).unionByName(joined.select(names))

"""Secret scans with a random forest that removes false positives. DataFrame functions and MLlib only.

Candidates are long runs of characters that keys are made of. Each is described by its length, its
characters and their transitions (also how likely these are in the words of the corpus), the share
covered by dictionary words, the path it was found under and the words beside it. A random forest
trained on labelled findings then scores every candidate.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from panelkit.llm.registry import query, table
from panelkit.session import scratch_path, store

CANDIDATE = r"[A-Za-z0-9+/_=\-]{16,}"
BLANKS = r"[\x20\x09-\x0D]+"
NAMED = r"(?i)(api|key|token|secret|passw|pwd|credential|auth|bearer)"
DICTIONARY = 50_000  # most frequent words of WORD_SIZES letters
WORD_SIZES = (4, 8)
LABELLED = 20_000  # labelled findings trained on, drawn by hash
TREES, DEPTH = 40, 6
LEAST_SCORE = 0.5
FEATURES = [
    "length", "digits", "capitals", "small", "symbols", "hexadecimal", "distinct", "kind_changes", "case_changes", "likelihood", "coverage",
    "path_depth", "path_code", "path_sample", "named_before", "named_after", "assigned", "quoted",
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """doc_id, path, position (of the word), place (in the word), word, before, earlier, after, candidate."""
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{path_col}`").cast("string"), F.lit("")).alias("path"), F.col(f"`{text_col}`").alias("text"))
    own = own.filter(F.col("text").rlike(CANDIDATE))
    own = own.select("doc_id", "path", F.filter(F.split("text", BLANKS), lambda w: w != "").alias("word"))
    last = F.size("word")
    own = own.withColumns({
        "position": F.sequence(F.lit(0), last - 1),
        "before": F.concat(F.array(F.lit("")), "word"), "earlier": F.concat(F.array(F.lit(""), F.lit("")), "word"),
        "after": F.concat(F.slice("word", F.lit(2), last), F.array(F.lit(""))),
    })
    zipped = F.filter(F.arrays_zip("position", "word", "before", "earlier", "after"), lambda z: z["word"].rlike(CANDIDATE))
    own = own.select("doc_id", "path", F.explode(zipped).alias("z")).select("doc_id", "path", "z.*")
    return own.select("*", F.posexplode(F.regexp_extract_all("word", F.lit(CANDIDATE), F.lit(0))).alias("place", "candidate"))


def dictionary(docs: DataFrame, text_col: str = "text", most: int = DICTIONARY) -> DataFrame:
    """entry, count of the most frequent words of a-z; counted over all documents before they are cut to ``most``."""
    low, high = WORD_SIZES
    words = docs.select(F.explode(F.split(F.lower(F.col(f"`{text_col}`")), BLANKS)).alias("entry")).filter(F.col("entry").rlike(f"^[a-z]{{{low},{high}}}$"))
    return words.groupBy("entry").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "entry").limit(most)


def share(column: Column, pattern: str) -> Column:
    return F.regexp_count(column, F.lit(pattern)) / F.length(column)


def transitions(entries: DataFrame) -> Column:
    """A map from two letters to the logarithm of the second's share after the first: 676 entries at most."""
    pairs = entries.select("count", F.explode(F.transform(F.sequence(F.lit(1), F.length("entry") - 1), lambda i: F.substr("entry", i, F.lit(2)))).alias("pair"))
    pairs = pairs.groupBy("pair").agg(F.sum("count").alias("n"))
    heads = pairs.groupBy(F.substring("pair", 1, 1).alias("head")).agg(F.sum("n").alias("all"))
    rows = pairs.join(heads, F.substring("pair", 1, 1) == F.col("head")).select("pair", F.log(F.col("n") / F.col("all")).alias("log")).orderBy("pair").collect()
    if not rows:
        return F.expr("map('', 0.0D)")
    return F.map_from_arrays(F.array(*[F.lit(r["pair"]) for r in rows]), F.array(*[F.lit(r["log"]) for r in rows]))


def covered(found: DataFrame, entries: DataFrame) -> DataFrame:
    """candidate, coverage: the share of its characters that dictionary words cover, for distinct candidates."""
    low, high = WORD_SIZES
    distinct = found.select("candidate").distinct().withColumn("plain", F.lower("candidate"))
    spots = distinct.select("candidate", "plain", F.explode(F.sequence(F.lit(1), F.length("plain") - low + 1)).alias("at"))
    parts = spots.select("candidate", "at", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.substr("plain", F.col("at"), F.lit(n)).alias("entry")) for n in range(low, high + 1)])).alias("p")).select("candidate", "at", "p.*")
    parts = parts.filter(F.length("entry") == F.col("n")).join(entries.select("entry"), "entry")
    # The longest word at each place, then the letters beyond the furthest end so far, are enough.
    longest = parts.groupBy("candidate", "at").agg(F.max("n").alias("n"))
    spans = longest.groupBy("candidate").agg(F.array_sort(F.collect_list(F.struct("at", "n"))).alias("spans"))
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("far"))
    total = F.aggregate("spans", start, lambda acc, s: F.struct(
        (acc["sum"] + F.greatest(F.lit(0), s["at"] + s["n"] - F.greatest(s["at"], acc["far"]))).alias("sum"),
        F.greatest(acc["far"], s["at"] + s["n"]).alias("far"),
    ))
    return spans.select("candidate", (total["sum"] / F.length("candidate")).alias("coverage"))


def described(found: DataFrame, entries: DataFrame) -> DataFrame:
    """``found`` with the columns of FEATURES."""
    c, flag = F.col("candidate"), lambda x: x.cast("double")
    table_of = transitions(entries)
    pairs = F.regexp_count(c, F.lit("(?i)(?=[a-z][a-z])"))
    steps = F.transform(F.sequence(F.lit(1), F.length(c) - 1), lambda i: F.try_element_at(F.col("logs"), F.substr(F.lower(c), i, F.lit(2))))
    likely = F.aggregate(steps, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(-8.0)))
    lead = F.expr("substring(word, 1, instr(word, candidate) - 1)")
    out = found.join(covered(found, entries), "candidate", "left").withColumn("logs", table_of)
    return out.withColumns({
        "length": flag(F.length(c)), "digits": share(c, "[0-9]"), "capitals": share(c, "[A-Z]"), "small": share(c, "[a-z]"), "symbols": share(c, r"[^A-Za-z0-9]"),
        "hexadecimal": share(c, "[0-9a-fA-F]"), "distinct": F.size(F.array_distinct(F.split(c, ""))) / F.length(c),
        "kind_changes": share(c, r"(?<=[A-Za-z])(?=[^A-Za-z])|(?<=[0-9])(?=[^0-9])|(?<=[^A-Za-z0-9])(?=[A-Za-z0-9])"),
        "case_changes": share(c, r"(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])"),
        # Pairs that are no letters, or that no dictionary word has, count as most unlikely.
        "likelihood": F.when(pairs > 0, likely / (F.length(c) - 1)).otherwise(F.lit(-8.0)),
        "coverage": F.coalesce("coverage", F.lit(0.0)),
        "path_depth": flag(F.regexp_count("path", F.lit("/"))), "path_code": flag(F.col("path").rlike(r"(?i)\.(py|js|ts|java|go|c|cc|rb|sh|env|ya?ml|json|toml|ini|cfg|conf)$")),
        "path_sample": flag(F.col("path").rlike("(?i)(test|sample|example|fixture|mock|doc)")),
        "named_before": flag(F.concat_ws(" ", "earlier", "before", lead).rlike(NAMED)), "named_after": flag(F.col("after").rlike(NAMED)),
        "assigned": flag(F.concat(F.col("before"), lead).rlike("[=:][\"'`]*$")), "quoted": flag(F.col("word").rlike("[\"'`]")),
    }).drop("logs")


def label_by_rule(found: DataFrame) -> DataFrame:
    """Labelled findings where nobody labelled any: a value assigned to a name that says key is a finding if
    it holds letters and digits; what is not assigned and has no digit is none. All others have no label."""
    named = (F.col("named_before") == 1) & (F.col("assigned") == 1) & (F.col("digits") > 0) & (F.col("digits") < 1)
    none = (F.col("named_before") == 0) & (F.col("assigned") == 0) & (F.col("digits") == 0)
    return found.withColumn("label", F.when(named, 1.0).when(none, 0.0)).filter("label IS NOT NULL")


def train(labelled: DataFrame, most: int = LABELLED) -> RandomForestClassificationModel | float:
    """The forest, from at most ``most`` labelled findings (FEATURES and label); a number if all labels are equal.

    It is written to the shared folder and read back: a forest that was fitted in a session keeps hold of the
    session, which cannot be sent to the tasks that score.
    """
    drawn = store(labelled.orderBy(F.xxhash64("candidate", "before", "after"), "candidate", "doc_id").limit(most).select("label", *FEATURES), "findings")
    kinds = drawn.select("label").distinct().collect()
    if len(kinds) < 2:
        return kinds[0]["label"] if kinds else 0.0
    rows = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(drawn)
    fitted = RandomForestClassifier(featuresCol="vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=7).fit(rows)
    path = scratch_path(labelled.sparkSession, "forest")
    fitted.write().save(path)
    return RandomForestClassificationModel.load(path)


def scored(found: DataFrame, model: RandomForestClassificationModel | float) -> DataFrame:
    if isinstance(model, float):
        return found.withColumn("score", F.lit(model))
    rows = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(found)
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")


def secret_scan(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per candidate of every whole text: doc_id, path, position, place, candidate, the FEATURES, score,
    secret (score of LEAST_SCORE or more).

    ``labelled`` has FEATURES and label (1.0 or 0.0); without it findings are labelled by ``label_by_rule``.
    Null, empty and blank texts have no candidates; a null path is the empty one. Repeated rows give
    repeated findings. If all labels are equal every candidate gets that label's score, without labels
    0. Other columns are not read.
    """
    entries = store(dictionary(docs, text_col), "dictionary")
    found = store(described(store(candidates(docs, id_col, text_col, path_col), "candidates"), entries), "described")
    model = train(label_by_rule(found) if labelled is None else labelled)
    out = scored(found, model).select("doc_id", "path", "position", "place", "candidate", *FEATURES, "score")
    return out.withColumn("secret", F.col("score") >= LEAST_SCORE)


@query("op4_secret_scan")
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents")).select("doc_id", "position", "place", "candidate", F.round("score", 6).alias("score"), "secret")

"""Quality classifier: evidence of each document, shrunk site by site.

Two logistic regressions, on the words that go with a class and a few figures of the text, give the chance that a document is of good quality
and that it is toxic; their product is the document's evidence. Sites come in two levels, host and path (here: source and
language). Each level's mean evidence is pulled toward the level above by an empirical Bayes weight, as many documents
as the spread between sites suggests, so a sparse site hardly counts for itself. The document's log-odds are then moved
from the global prior to its site's. All site figures are grouped sums.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import pick, stored, text_of, words_of

#: Labelled documents that the regressions are fitted on at most: those with the smallest hash of their id.
SAMPLE = 20_000
#: A word is a feature if so many labelled documents hold it and it goes with a class beyond so many standard errors; of
#: these the most significant, up to ``WORDS``.
HELD, SIGNIFICANT, WORDS = 5, 4.0, 4096
REGULARISED = 0.001
#: Documents that a level above counts for, at least and at most.
WEAKEST, STRONGEST = 5.0, 10_000.0
KEEP = 0.5
FIGURES = ["n_words", "mean_length", "symbols", "digits", "variety", "lines"]


def features(docs: DataFrame) -> DataFrame:
    """``docs`` (``text``, never null) with its different words and its figures, all between about 0 and 1."""
    text, n = F.col("text"), F.greatest(F.size("words"), F.lit(1))
    rows = docs.withColumn("words", words_of(F.lower(text)))
    chars = F.greatest(F.length("text"), F.lit(1))
    marks = F.filter(F.array_distinct(F.transform("words", lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))), lambda w: w != "")
    lines = F.split(text, "\n")
    return rows.select(
        *docs.columns, marks.alias("terms"), (F.log1p(F.size("words").cast("double")) / 10).alias("n_words"),
        (F.length(F.array_join("words", "")) / n / 20).alias("mean_length"),
        (F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s.,]+", "")) / chars * 10).alias("symbols"),
        (F.length(F.regexp_replace(text, r"[^0-9]+", "")) / chars * 10).alias("digits"),
        (F.size(F.array_distinct("words")) / n).alias("variety"),
        (1 - F.size(F.array_distinct(lines)) / F.size(lines)).alias("lines"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict[str, PipelineModel | float]:
    """A model for ``quality`` and for ``toxic``; a plain rate where the labels have one class only, or none."""
    known = pick(labels, {"doc_id": "long", "quality": "int", "toxic": "int"}).where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality"), F.max("toxic").alias("toxic")).where("quality IS NOT NULL OR toxic IS NOT NULL")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = pick(docs, {"doc_id": "long", "text": "string"}).select("doc_id", text_of().alias("text"))
    train = stored(features(texts.join(F.broadcast(chosen), "doc_id")).drop("text"), "labelled")
    models: dict[str, PipelineModel | float] = {}
    for target, default in (("quality", 1.0), ("toxic", 0.0)):
        rows = train.where(F.col(target).isin(0, 1)).withColumn("label", F.col(target).cast("double"))
        found = rows.agg(F.count("label").alias("n"), F.sum("label").alias("ones")).first()
        if not found["n"] or found["ones"] in (0, found["n"]):
            models[target] = found["ones"] / found["n"] if found["n"] else default
            continue
        models[target] = Pipeline(stages=[
            CountVectorizerModel.from_vocabulary(_telling(rows, found["n"], found["ones"]), inputCol="terms", outputCol="held", binary=True),
            VectorAssembler(inputCols=["held", *FIGURES], outputCol="features"),
            LogisticRegression(regParam=REGULARISED, maxIter=100, probabilityCol="chance", rawPredictionCol="raw",
                               predictionCol="class"),
        ]).fit(rows)
    return models


def _telling(rows: DataFrame, docs: int, ones: float) -> list[str]:
    """The words whose share of labels differs from that of all documents, most significant first."""
    rate = ones / docs
    counts = rows.select("label", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("held"), F.sum("label").alias("ones")).where(F.col("held") >= HELD)
    z = F.abs(F.col("ones") - F.col("held") * rate) / F.sqrt(F.col("held") * rate * (1 - rate))
    top = counts.withColumn("z", z).where(F.col("z") >= SIGNIFICANT).orderBy(F.desc("z"), "term").limit(WORDS)
    return [row["term"] for row in top.select("term").collect()] or [""]


def _chance(frame: DataFrame, model: PipelineModel | float, name: str) -> DataFrame:
    if isinstance(model, float):
        return frame.withColumn(name, F.lit(model))
    found = model.transform(frame).withColumn(name, vector_to_array("chance")[1])
    return found.drop("held", "features", "raw", "chance", "class")


def evidence(docs: DataFrame, models: dict[str, PipelineModel | float]) -> DataFrame:
    """``doc_id, host, path, quality, toxic, p`` for every row of ``docs`` (``doc_id``, ``text``, ``source``, ``lang``)."""
    rows = pick(docs, {"doc_id": "long", "text": "string", "source": "string", "lang": "string"}).select(
        "doc_id", F.coalesce("source", F.lit("")).alias("host"), F.coalesce("lang", F.lit("")).alias("path"), text_of().alias("text"))
    found = _chance(_chance(features(rows), models["quality"], "quality"), models["toxic"], "toxic")
    return found.select("doc_id", "host", "path", "quality", "toxic", (F.col("quality") * (1 - F.col("toxic"))).alias("p"))


def _logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(inside / (1 - inside))


def _strength(groups: DataFrame, above: Column) -> float:
    """How many documents the level above counts for: by the spread of the sites' means around it, beyond chance."""
    mean = F.col("total") / F.col("docs")
    found = groups.where("docs > 1").agg(
        F.sum(F.col("docs") * (mean - above) ** 2).alias("between"), F.sum("docs").alias("docs"), F.count(F.lit(1)).alias("sites"),
        F.sum(F.col("squares") - F.col("total") * mean).alias("within")).first()
    if not found["sites"] or found["docs"] <= found["sites"]:
        return STRONGEST
    within = max(found["within"], 0.0) / (found["docs"] - found["sites"])
    spread = (found["between"] - found["sites"] * within) / found["docs"]
    return min(STRONGEST, max(WEAKEST, within / spread)) if spread > 0 else STRONGEST


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, quality, toxic, site, score, kept`` for every row of ``docs``.

    ``quality`` and ``toxic`` are the regressions' chances, ``site`` the shrunk mean of the other documents of the same
    path, ``score`` the chance after both. Null text counts as empty, a null source or language as the empty one; null ids
    are kept; repeated rows count and come out as often. Very long texts are read whole, a score at the limit is kept, and
    columns of other names are not read. Without labels of a class the known rate stands for the model. An empty table gives
    an empty one. Documents have no url: their language stands for the path.
    """
    found = stored(evidence(docs, fit(docs, labels, sample)), "evidence")
    sums = [F.count(F.lit(1)).alias("docs"), F.sum("p").alias("total"), F.sum(F.col("p") ** 2).alias("squares")]
    paths = stored(found.groupBy("host", "path").agg(*sums), "paths")
    hosts = paths.groupBy("host").agg(*[F.sum(name).alias(name) for name in ("docs", "total", "squares")])
    whole = hosts.agg(F.sum("total").alias("total"), F.sum("docs").alias("docs")).first()
    prior = whole["total"] / whole["docs"] if whole["docs"] else 0.5
    by_host = _strength(hosts, F.lit(prior))
    host_mean = hosts.select("host", ((F.col("total") + by_host * prior) / (F.col("docs") + by_host)).alias("host_mean"))
    nested = stored(paths.join(host_mean, "host"), "sites")
    by_path = _strength(nested, F.col("host_mean"))
    site = (F.col("total") - F.col("p") + by_path * F.col("host_mean")) / (F.col("docs") - 1 + by_path)
    moved = _logit(F.col("p")) + _logit(F.col("site")) - _logit(F.lit(prior))
    return found.join(nested.select("host", "path", "docs", "total", "host_mean"), ["host", "path"]).withColumn("site", site).withColumn(
        "score", 1 / (1 + F.exp(-moved))).select("doc_id", "quality", "toxic", "site", "score", (F.col("score") >= KEEP).alias("kept"))

"""From documents to a training corpus, in the order of STAGES; each stage is written and read again by the next.

Every stage works on the rows its predecessor kept and returns the columns of ``documents``, but the last, which returns the
mixture: a row for each document with the number of times it is taken. Stages that carry decisions back to rows number them first, so null and
repeated doc_ids are rows like others. Extra columns pass through whatever their names, ``n_chars`` may be missing, null and empty texts are
rejected by the first stage only, texts of any length are read whole, and empty tables stay empty.
"""

from pyspark.sql import functions as F

from tabloom.llm import decontaminate, language, mixing, near_dedup, secrets
from tabloom.llm.catalog import remainder
from tabloom.session import materialize, with_row_id

CERTAIN = 0.75      # least mean probability of the words' likeliest languages: texts in languages or scripts not learned stay below


def free(docs, name):
    """A name near ``name`` that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def columns(docs):
    return [F.col(f"`{c}`") for c in docs.columns]


def language_stage(spark, docs, sf_dir):
    """Rejects texts without a language: null, empty, without any letter, or of words that the field cannot tell (``CERTAIN``)."""
    into = free(docs, "__language")
    field = language.fit_languages(docs.filter(remainder("doc_id", 3) != 1))
    found = language.label_languages(docs, field, into=into)
    return found.filter((F.col(into)["lang"] != "und") & (F.col(into)["certainty"] >= CERTAIN)).select(*columns(docs))


def near_dedup_stage(spark, docs, sf_dir):
    """Keeps one document of each group of near-duplicates of five-word shingles at a similarity of 0.8: the least doc_id, nulls last."""
    row = free(docs, "__id")
    rows = with_row_id(docs, row)
    key = F.struct(F.col("doc_id").isNull().alias("missing"), F.col("doc_id"), F.col(row).alias("row"))
    found = near_dedup.near_duplicates(rows.select("text", key.alias("key"), F.col(row).alias("row")), key="key", width=5, percent=80, row="row")
    kept = found.filter("kept").select(F.col("key")["row"].alias(row))
    return rows.join(kept, row, "left_semi").select(*columns(docs))


def decontaminate_stage(spark, docs, sf_dir):
    """Rejects documents that the contamination rule marks."""
    into = free(docs, "__overlap")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = decontaminate.mark_contaminated(docs, benchmark, into=into)
    return marked.filter(~F.col(into)["contaminated"]).select(*columns(docs))


def secrets_stage(spark, docs, sf_dir):
    """Blanks out owner-specific secrets; widely copied examples stay."""
    into = free(docs, "__secrets")
    found = secrets.scan_secrets(docs, into=into, with_text=True)
    redacted = found.withColumn("text", secrets.redact(F.col("text"), F.col(into)))
    if "n_chars" in docs.columns:
        redacted = redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return redacted.select(*columns(docs))


def mix_stage(spark, docs, sf_dir):
    """Takes each source's documents up to its target weight."""
    return mixing.mix_sources(docs).filter("taken > 0").select("doc_id", "source", "size", "target", "taken", "copies")


STAGES = [
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("secrets", secrets_stage),
    ("mix", mix_stage),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs

"""The queries of this package, each over the whole of its table, with SQL where SQL can express them."""

from pyspark.sql import functions as F

from tabloom.llm import chat, decontaminate, language, mixing, near_dedup, negatives, quality, repeats, runs, secrets, tokens, topk, toxicity

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def register(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function
    return register


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key, n):
    """crc32 of the key as text, modulo n: the folds of the learned operators."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


@query("op1_language_crf")
def op1_language_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    field = language.fit_languages(docs.filter(remainder("doc_id", 3) != 1))
    found = language.label_languages(docs, field, keep=["doc_id"])
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


@query("op2_top_k", topk.SQL)
def op2_top_k(spark, sf_dir):
    return topk.top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op3_decontaminate", decontaminate.SQL)
def op3_decontaminate(spark, sf_dir):
    marked = decontaminate.mark_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return marked.select("doc_id", *[f"overlap.{c}" for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")])


@query("op4_quality_neighbours")
def op4_quality_neighbours(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    voter = quality.fit_neighbours(docs.filter(remainder("doc_id", 5) != 0), table(spark, sf_dir, "labels"))
    return judged(quality.score_quality(docs, voter, keep=["doc_id"]), "quality")


@query("op5_toxicity_models")
def op5_toxicity_models(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    models = toxicity.fit_models(docs.filter(remainder("doc_id", 5) != 0), table(spark, sf_dir, "labels"), remainder("doc_id", 5) == 1)
    return judged(toxicity.score_toxicity(docs, models, keep=["doc_id"]), "toxicity")


def judged(scored, into):
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, F.col(f"{into}.score").alias("score"), F.col(f"{into}.predicted").alias("predicted"))


@query("op6_near_duplicates", near_dedup.SQL)
def op6_near_duplicates(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_token_counts")
def op7_token_counts(spark, sf_dir):
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return counted.select("doc_id", "tokens.n_words", "tokens.n_tokens", "tokens.n_unknown")


@query("op8_secret_ownership")
def op8_secret_ownership(spark, sf_dir):
    found = secrets.scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    finds = F.col("secrets")
    base = F.filter(finds, lambda f: f["kind"] < 3)

    def count(field, value):
        return F.size(F.filter(finds, lambda f: f[field] == value)).cast("long")

    of_kind = [count("kind", k).alias(f"n_{name}") for k, name in enumerate(secrets.KINDS[:3])]
    of_verdict = [count("verdict", v).alias(f"n_{v}") for v in ("live", "example")]
    return found.select("doc_id", *of_kind, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(finds).alias("spans"), *of_verdict)


@query("op9_remove_repeats")
def op9_remove_repeats(spark, sf_dir):
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), "kept_sha256")


@query("op10_mix_sources", mixing.SQL.format(documents="documents"))
def op10_mix_sources(spark, sf_dir):
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op11_chat_format", chat.SQL)
def op11_chat_format(spark, sf_dir):
    """All conversations and conversation -7, whose texts are control strings; every digest is read back from the output."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    done = chat.format_chats(rows.unionByName(planted)).withColumn("formatted", chat.joined(F.col("segments")))
    done = done.withColumn("turns", chat.read_back(F.col("formatted"))).withColumn("learned", chat.learned_text(F.col("segments")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid", "complete")


WORD = r"[^\x20\x09-\x0D]+"


def with_planted_period(docs):
    """The contract's texts: where crc32 of the key ends in 0, the words from some place on repeat with some period."""
    key = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(key % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    parts = docs.withColumn("__g", F.floor(key / 10)).withColumn("__words", words).withColumn("__n", F.coalesce(F.size("__words"), F.lit(0)))
    parts = parts.withColumn("__a", F.when(F.col("__n") > 0, F.col("__g") % F.col("__n")).cast("int"))
    left = F.col("__n") - F.col("__a")
    period = (1 + F.floor(left / (3 + F.col("__g") % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice("__words", F.col("__a") + 1, period), F.ceil(left / period).cast("int")))
    planted = F.array_join(F.concat(F.slice("__words", F.lit(1), F.col("__a")), F.slice(again, F.lit(1), left)), " ")
    return parts.select("doc_id", F.when(F.col("__n") > 0, planted).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    docs = with_planted_period(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = runs.find_runs(docs, keep=["doc_id"])
    longest = F.array_min(F.transform("periodic.runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period"))))
    found = found.withColumn("longest", longest).withColumn("length", -F.col("longest.shorter"))
    return found.select("doc_id", F.size("periodic.runs").cast("long").alias("n_runs"), "longest.start", "length", "longest.period",
                        F.expr("1000 * length div longest.period").alias("exponent_milli"), "periodic.runs_sha256", "periodic.collapsed_sha256")


@query("op13_hard_negatives", negatives.SQL)
def op13_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(rows.withColumn("label", label), F.col("key") % 100 == 0)

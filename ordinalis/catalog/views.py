"""Review-shaped tables derived from whole driver tables; ``oracles`` holds the same as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MODELS = {"boost_a": (37, 11), "boost_b": (41, 13), "boost_c": (43, 17), "forest": (47, 19)}
TRIALS = 10
ROUNDS = 40
LOGITS = ((3, 0), (5, 1), (2, 2), (6, 3), (4, 4))

# Parameter of the lexicon translator, not data: (lang, token, dst).
LEXICON = (("fr", "le", "the"), ("fr", "la", "the"), ("fr", "les", "the"), ("fr", "et", "and"),
           ("fr", "que", "that"), ("fr", "pour", "for"), ("de", "und", "and"), ("de", "nicht", "not"),
           ("de", "der", "the"), ("de", "die", "the"), ("es", "el", "the"), ("es", "la", "the"),
           ("es", "y", "and"), ("es", "que", "that"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _d(value) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("double")


def review_id(conv: Column, turn: Column) -> Column:
    """One number for two, without collisions: their place on the diagonals of a grid."""
    return F.shiftright((conv + turn) * (conv + turn + 1), 1) + turn


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn is the review, the assistant turn after it the reply.

    The join key holds the turn, so one endless conversation spreads over all tasks.
    """
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("utext"))
    answered = (turns.where(F.col("role") == "assistant")
                .select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("rtext")))
    x = (asked.join(answered, ["conv_id", "turn"], "left")
         .withColumns({"id": review_id(F.col("conv_id"), F.col("turn")), "h": F.col("conv_id") * 31 + F.col("turn") * 7}))
    h, u, r = F.col("h"), F.col("utext"), F.col("rtext")
    review = (F.when(h % 11 == 0, F.lit("")).when(h % 11 == 1, F.lit(None)).when(h % 11 == 2, F.lit("😀👍"))
              .when(h % 11 == 3, F.lit("👍🏽")).when(h % 11 == 4, F.concat(u, F.lit(" push Keep baguséx")))
              .when(h % 11 == 5, F.concat(u, F.lit(" challenging?"))).when(h % 11 == 6, F.lit("❤️")).otherwise(u))
    tail = (F.when(h % 9 == 0, F.lit(" SORRY about this Issue")).when(h % 9 == 1, F.lit(" please rate Five Stars"))
            .when(h % 9 == 2, F.lit(" call 08121214017")).when(h % 9 == 3, F.lit(" cs@bank.co.id."))
            .when(h % 9 == 4, F.lit(" Thanks, your transactions")).otherwise(F.lit("")))
    days = F.when(h % 17 == 3, F.lit("05:06:00")).otherwise(F.concat((h % 40).cast("string"), F.lit(" days 05:06:00")))
    return x.select(
        "id", review.alias("review"),
        F.when(h % 5 != 0, ((h * 13 + F.length(u)) % 5).cast("int")).alias("score"),
        (((h % 97) * (h % 97)) % 97).alias("thumbsUpCount"),
        F.concat((h % 4).cast("string"), F.lit("."), (h % 10).cast("string"), F.lit(".0")).alias("reviewCreatedVersion"),
        F.concat(r, tail).alias("replyContent"),
        F.when(r.isNotNull(), days).alias("timeToReply"),
        F.when(h % 5 == 0, F.lit("test")).otherwise(F.lit("train")).alias("split"))


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regressor outputs of ten trials for every order: the label plus a spread around it."""
    key = F.col("id")
    y = ((key * 7 + F.col("o_custkey")) % 5).cast("int")
    trial = F.explode(F.array(*[F.lit(t) for t in range(TRIALS)])).alias("trial")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey", trial)
    noisy = [(_d(y) + (_d((key * a + F.col("trial") * b) % 301) - _d(150)) / _d(100)).alias(name)
             for name, (a, b) in MODELS.items()]
    return rows.select("id", "trial", (key % 10).alias("fold"), y.alias("y"), *noisy)


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, y, increments): forty boosting rounds per order, in steps of 1/256."""
    y = F.col("id") % 5

    def step(i: Column) -> Column:
        return (F.when(i == 1, _d(2)).when(i <= 17, (_d(y) - _d(2)) / _d(16))
                .otherwise((_d((F.col("id") * 37) % 101) - _d(50)) / _d(256)))

    return (table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
            .select("id", y.cast("int").alias("y"),
                    F.array(*[step(F.lit(i + 1)) for i in range(ROUNDS)]).alias("increments")))


def epoch_logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(epoch, id, batch, y, logits): class scores of three epochs for every order."""
    key, y = F.col("id"), F.col("id") % 5
    epoch = F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("epoch")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), epoch)
    logits = [_d((key * a + b) % 7) / _d(4) + F.when(y == k, _d(F.col("epoch"))).otherwise(_d(0))
              for k, (a, b) in enumerate(LOGITS)]
    return rows.select("epoch", "id", F.expr("id div 16").alias("batch"), y.cast("int").alias("y"),
                       F.array(*logits).alias("logits"))


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A learnable table: ``score`` is a step function of ``sum_qty``; ``noisy`` adds up three columns and
    a spread that none of them tells, so one tree does not find it."""
    total = F.sum("l_quantity")
    tax = F.round(F.max("l_tax") * 100).cast("bigint")
    added = (total.cast("bigint") + tax * 8 + F.count(F.lit(1)) * 12 + (F.col("l_orderkey") * 37) % 41 - 20)
    noisy = F.least(F.lit(4), F.floor(F.greatest(F.lit(0), added) / 80)).cast("int")
    return (table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
            .agg(F.least(F.lit(4), F.floor(total / _d(40)).cast("int")).alias("score"), noisy.alias("noisy"), total.alias("sum_qty"),
                 F.avg("l_discount").alias("avg_disc"), F.max("l_tax").alias("max_tax"),
                 F.count(F.lit(1)).alias("n_lines")).withColumnRenamed("l_orderkey", "id"))


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON), "lang string, token string, dst string")

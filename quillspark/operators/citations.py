"""The citation graph: edges, reach, growth, ranks and likeness to a centroid."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import checkpointed, first_wins


def edges(candidates: DataFrame) -> DataFrame:
    """Forward: the candidate cites the seed; reverse: the seed cites the candidate.  A reverse edge replaces the same forward edge."""
    forward = F.col("source_type") == "forward"
    rows = candidates.filter(forward | (F.col("source_seed_doi") != "")).select(
        F.when(forward, F.col("doi")).otherwise(F.col("source_seed_doi")).alias("citing_doi"),
        F.when(forward, F.col("source_seed_doi")).otherwise(F.col("doi")).alias("cited_doi"),
        F.col("source_type").alias("source_pipeline"),
        "source_project",
    )
    return first_wins(rows, ["citing_doi", "cited_doi", "source_project"], [F.desc("source_pipeline")])


def in_degree(links: DataFrame) -> DataFrame:
    return links.groupBy(F.col("cited_doi").alias("doi")).agg(F.count_distinct("citing_doi").alias("n_citing"))


def reach(links: DataFrame, seeds: DataFrame, depth: int) -> DataFrame:
    """Nodes within depth steps of the seeds along citing -> cited, with their least distance."""
    seen = seeds.select("doi").distinct().withColumn("distance", F.lit(0))
    front = seen
    hop = checkpointed(links.select("citing_doi", "cited_doi").distinct())
    for d in range(1, depth + 1):
        step = hop.join(front.select(F.col("doi").alias("citing_doi")), "citing_doi", "left_semi").select(F.col("cited_doi").alias("doi")).distinct()
        front = checkpointed(step.join(seen, "doi", "left_anti").withColumn("distance", F.lit(d)))
        seen = seen.unionByName(front)
    return seen


def growth(log: DataFrame, order: str, value: str) -> DataFrame:
    """Growth in percent over the row before; null before any, infinite after zero."""
    before = F.lag(value).over(Window.orderBy(order))
    rate = F.when(before == 0, F.lit(float("inf"))).otherwise(100.0 * (F.col(value) - before) / before)
    return log.withColumn("n_before", before).withColumn("growth_pct", rate).withColumn("converged", F.coalesce((F.col("growth_pct") < 1.0) & (F.col("n_before") > 0), F.lit(False)))


def snowball(expand, count, state, max_rounds: int = 3, until: float = 1.0):
    """Expands until the count grows by less than until percent; a failed step ends it without convergence."""
    before, log = count(state), []
    for i in range(1, max_rounds + 1):
        try:
            state = expand(state)
        except Exception as e:  # a failed step must not look like convergence
            return state, [*log, {"iter": i, "failed": str(e)[:200]}], False
        after = count(state)
        pct = float("inf") if not before else 100.0 * (after - before) / before
        log.append({"iter": i, "n_before": before, "n_after": after, "growth_pct": pct})
        if before and pct < until:
            return state, log, True
        before = after
    return state, log, False


def pagerank(links: DataFrame, rounds: int = 10, damping: float = 0.85) -> DataFrame:
    """Ranks by iterated joins, each round cut from its lineage in the shared checkpoint folder."""
    hop = links.select(F.col("citing_doi").alias("s"), F.col("cited_doi").alias("t")).distinct()
    out = hop.groupBy("s").agg(F.count(F.lit(1)).alias("d"))
    nodes = hop.select(F.col("s").alias("doi")).union(hop.select("t")).distinct()
    rank = nodes.withColumn("rank", F.lit(1.0))
    weighted = checkpointed(hop.join(out, "s"))
    for i in range(rounds):
        given = weighted.join(rank.select(F.col("doi").alias("s"), "rank"), "s").groupBy(F.col("t").alias("doi")).agg(F.sum(F.col("rank") / F.col("d")).alias("g"))
        rank = nodes.join(given, "doi", "left").select("doi", (1 - damping + damping * F.coalesce("g", F.lit(0.0))).alias("rank"))
        if i % 5 == 4:
            rank = checkpointed(rank)
    return rank


def centroid_likeness(vectors: DataFrame, seeds: DataFrame, k: int) -> DataFrame:
    """The k vectors most like the mean of the seeds' vectors, by cosine; the mean is one row."""
    part = vectors.join(seeds, "vec_id", "left_semi").select(F.posexplode("embedding").alias("i", "x"))
    mean = part.groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("m")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("c"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    e, c = F.col("embedding"), F.col("c")
    like = dot(e, c) / F.sqrt(dot(e, e) * dot(c, c))
    return vectors.join(F.broadcast(mean)).select("vec_id", F.round(like, 6).alias("likeness")).orderBy(F.desc("likeness"), "vec_id").limit(k)

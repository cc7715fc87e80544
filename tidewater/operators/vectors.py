"""Nearest neighbours for a bounded set of query vectors, fusion and retrieval measures."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.operators.ranking import top_n
from tidewater.session import cut_lineage

MAX_QUERIES = 1000

Queries = dict[int, Sequence[float]]


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def centroids(df: DataFrame, label: str, vector: str) -> Queries:
    """Mean vector per label, for use as queries; refuses more labels than a query set may have."""
    labels = df.select(label).distinct().limit(MAX_QUERIES + 1).count()
    if labels > MAX_QUERIES:
        raise ValueError(f"more than {MAX_QUERIES} labels")
    parts = df.select(label, F.posexplode(vector).alias("pos", "v")).groupBy(label, "pos").agg(F.avg(F.col("v").cast("double")).alias("m"))
    out: dict[int, list[float]] = {}
    for r in parts.orderBy(label, "pos").collect():
        out.setdefault(r[label], []).append(r["m"])
    return out


_QUERY = T.StructType([T.StructField("query", T.LongType()), T.StructField("q", T.ArrayType(T.DoubleType()))])


def query_frame(df: DataFrame, queries: Queries) -> DataFrame:
    if len(queries) > MAX_QUERIES:
        raise ValueError(f"more than {MAX_QUERIES} query vectors")
    return df.sparkSession.createDataFrame([(int(k), [float(x) for x in v]) for k, v in queries.items()], _QUERY)


def _matrix(queries: Queries) -> tuple[np.ndarray, np.ndarray]:
    if len(queries) > MAX_QUERIES:
        raise ValueError(f"more than {MAX_QUERIES} query vectors")
    return np.array(list(queries), dtype="int64"), np.array([list(v) for v in queries.values()], dtype="float64")


def _batch_best(item: str, vector: str, queries: Queries, k: int, measure: str):
    """For mapInPandas: the k best rows of each batch per query; every overall winner is among them."""
    names, q = _matrix(queries)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            x = np.stack(batch[vector].to_numpy()).astype("float64")
            items = batch[item].to_numpy()
            if measure == "cosine":
                lengths = np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(q, axis=1)[None, :]
                values = np.round(np.divide(x @ q.T, lengths, out=np.zeros_like(lengths), where=lengths > 0), 6)
                keys = -values
            else:
                values = np.round(np.stack([np.sqrt(((x - one) ** 2).sum(axis=1)) for one in q], axis=1), 6)  # never rows x queries x width
                keys = values
            for j, name in enumerate(names):
                best = np.lexsort((items, keys[:, j]))[:k]
                yield pd.DataFrame({"query": name, item: items[best], "score": values[best, j]})

    return run


def _best(df: DataFrame, item: str, vector: str, queries: Queries, k: int, measure: str) -> DataFrame:
    known = df.select(item, vector).where(F.col(vector).isNotNull())
    schema = T.StructType([T.StructField("query", T.LongType()), df.schema[item], T.StructField("score", T.DoubleType())])
    near = known.mapInPandas(_batch_best(item, vector, queries, k, measure), schema)
    order = F.desc("score") if measure == "cosine" else F.asc("score")
    return top_n(near, ["query"], [order, F.asc(item)], k, rank="rank").withColumn("rank", F.col("rank").cast("bigint"))


def knn(df: DataFrame, item: str, vector: str, queries: Queries, k: int) -> DataFrame:
    """The k rows nearest to each query vector by cosine.

    A batch is one matrix product and passes on at most k rows per query, so the
    shuffle carries winners only.
    """
    return _best(df, item, vector, queries, k, "cosine")


def knn_l2(df: DataFrame, item: str, vector: str, queries: Queries, k: int) -> DataFrame:
    """The same by Euclidean distance."""
    return _best(df, item, vector, queries, k, "l2").withColumnRenamed("score", "distance")


def _sign_codes(width: int, bands: int, bits: int, seed: int):
    """A vectorised function from vectors to one number per band: signs against fixed directions."""
    planes = np.random.default_rng(seed).standard_normal((bands * bits, width))
    weights = 1 << np.arange(bits)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def codes(vectors: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype=object)
        signs = (np.stack(vectors.to_numpy()).astype("float64") @ planes.T > 0).reshape(len(vectors), bands, bits)
        return pd.Series(list((signs * weights).sum(axis=2).astype("int32")))

    return codes


def knn_lsh(df: DataFrame, item: str, vector: str, queries: Queries, k: int, bands: int = 12, bits: int = 4, seed: int = 7) -> DataFrame:
    """Approximate neighbours: only rows that share a band with the query are scored, exactly."""
    codes = _sign_codes(len(next(iter(queries.values()))), bands, bits, seed)
    wanted = query_frame(df, queries).select("query", "q", F.posexplode(codes("q")).alias("band", "code"))
    placed = df.select(item, vector, codes(vector).alias("c")).select(item, vector, F.posexplode("c").alias("band", "code"))
    met = placed.join(F.broadcast(wanted), ["band", "code"])  # at most MAX_QUERIES * bands rows
    once = met.groupBy("query", item).agg(F.first(vector).alias(vector), F.first("q").alias("q"))
    best = once.select("query", item, F.round(cosine(F.col(vector), F.col("q")), 6).alias("score"))
    return top_n(best, ["query"], [F.desc("score"), F.asc(item)], k, rank="rank").withColumn("rank", F.col("rank").cast("bigint"))


def reciprocal_rank_fusion(lists: Sequence[DataFrame], item: str, k: int, damping: int = 60) -> DataFrame:
    """Merge ranked lists by the sum of 1 / (damping + rank)."""
    out = None
    for i, ranked in enumerate(lists):
        part = ranked.select(F.col(item).alias("item"), (F.lit(1.0) / (F.lit(damping) + F.col("rank"))).alias(f"s{i}"))
        out = part if out is None else out.join(part, "item", "full")
    total = sum((F.coalesce(f"s{i}", F.lit(0.0)) for i in range(len(lists))), F.lit(0.0))
    return out.select(F.col("item").alias(item), F.round(total, 8).alias("fused")).orderBy(F.desc("fused"), item).limit(k)


def retrieval_metrics(retrieved: DataFrame, relevant: DataFrame, item: str) -> DataFrame:
    """Recall and reciprocal rank of the first hit, per query."""
    wanted = relevant.groupBy("query").agg(F.count(F.lit(1)).alias("relevant"))
    hits = retrieved.join(relevant.select("query", item), ["query", item], "left_semi")
    found = hits.groupBy("query").agg(F.count(F.lit(1)).alias("hits"), F.min("rank").alias("first"))
    joined = wanted.join(found, "query", "left")
    return joined.select(
        "query", "relevant", F.coalesce("hits", F.lit(0)).alias("hits"),
        (F.coalesce("hits", F.lit(0)) / F.col("relevant")).alias("recall"), F.coalesce(F.lit(1.0) / F.col("first"), F.lit(0.0)).alias("reciprocal_rank"))


def win_rates(pairs: DataFrame, winner: str, loser: str) -> DataFrame:
    """Games, wins and win rate per contestant."""
    sides = F.array(F.struct(F.col(winner).alias("player"), F.lit(1).alias("win")), F.struct(F.col(loser).alias("player"), F.lit(0).alias("win")))
    each = pairs.select(F.inline(sides)).groupBy("player").agg(F.count(F.lit(1)).alias("games"), F.sum("win").alias("wins"))
    return each.withColumn("win_rate", F.col("wins") / F.col("games"))


def bradley_terry(pairs: DataFrame, winner: str, loser: str, rounds: int = 6, cut_every: int = 3) -> DataFrame:
    """Strengths from paired comparisons by repeated aggregation over the distinct pairings.

    A round scales with its input, so the mean is brought to 1 once at the end.
    """
    a, b = F.least(winner, loser), F.greatest(winner, loser)
    met = cut_lineage(pairs.groupBy(a.alias("a"), b.alias("b")).agg(F.count(F.lit(1)).alias("n")))
    both = met.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    wins = cut_lineage(win_rates(pairs, winner, loser).select(F.col("player").alias("a"), "wins", "games"))
    strength = wins.select("a", F.lit(1.0).alias("s"))
    for i in range(rounds):
        other = strength.select(F.col("a").alias("b"), F.col("s").alias("so"))
        load = both.join(strength, "a").join(other, "b").groupBy("a").agg(F.sum(F.col("n") / (F.col("s") + F.col("so"))).alias("load"))
        strength = wins.join(load, "a").select("a", (F.greatest(F.col("wins"), F.lit(0.5)) / F.col("load")).alias("s"))
        if (i + 1) % cut_every == 0:
            strength = cut_lineage(strength)
    mean = strength.agg(F.avg("s")).scalar()
    return strength.join(wins, "a").select(F.col("a").alias("player"), "games", "wins", F.round(F.col("s") / mean, 6).alias("strength"))

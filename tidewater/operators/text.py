"""Search, chunking and matching of text. Whole texts are read; only query terms are shuffled."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import LETTER_GAPS, jaccard, trigrams, words
from tidewater.operators.control import spread
from tidewater.operators.ordered import ordered, running, shift
from tidewater.operators.ranking import top_n

K1, B = 1.2, 0.75  # fixed values: the usual BM25 parameters


def _count(tokens: Column, term: str) -> Column:
    return F.size(F.filter(tokens, lambda w: w == term))


def bm25(df: DataFrame, doc: str, text: str, queries: dict[int, Sequence[str]], k: int) -> DataFrame:
    """The k best documents per query with score and rank.

    Words are counted in place.  Document frequencies are one aggregate and scoring
    is a projection, so neither words nor documents are shuffled, only the best
    rows of each task.
    """
    terms = sorted({t for q in queries.values() for t in q})
    if not all(t.isalpha() and t == t.lower() for t in terms):
        raise ValueError("query terms are lower-case words")
    # every word stands between blanks of its own, so counting " word " finds whole words only
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), LETTER_GAPS, "  ")), F.lit(" "))
    plain = spread(df.select(doc, text), doc).select(doc, spaced.alias("__t"))
    times = lambda piece: (F.length("__t") - F.length(F.replace(F.col("__t"), F.lit(piece), F.lit("")))) / len(piece)
    tf_of = {t: F.col(f"__tf{i}") for i, t in enumerate(terms)}
    counted = plain.select(
        doc, F.when(F.col("__t") == "  ", 0.0).otherwise(times(" ") / 2).alias("__len"), *[times(f" {t} ").alias(f"__tf{i}") for i, t in enumerate(terms)]
    )
    facts = counted.agg(
        F.count(F.lit(1)).alias("n"), F.sum("__len").alias("total"), *[F.count_if(tf_of[t] > 0).alias(f"df_{i}") for i, t in enumerate(terms)]
    ).first()
    n, mean = facts["n"], (facts["total"] or 0) / max(1, facts["n"])
    idf = {t: math.log((n - facts[f"df_{i}"] + 0.5) / (facts[f"df_{i}"] + 0.5) + 1) for i, t in enumerate(terms)}
    norm = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * F.col("__len") / F.lit(mean or 1.0))
    scored = []
    for q, wanted in queries.items():
        score = F.lit(0.0)
        for t in wanted:
            score = score + F.lit(idf[t]) * tf_of[t] * (K1 + 1) / (tf_of[t] + norm)
        scored.append(F.struct(F.lit(q).cast("bigint").alias("query"), F.round(score, 8).alias("score")))
    hits = counted.select(doc, F.inline(F.array(*scored))).where("score > 0")
    return top_n(hits, ["query"], [F.desc("score"), F.asc(doc)], k, rank="rank").withColumn("rank", F.col("rank").cast("bigint"))


def inverted_index(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(term, doc, tf) rows; counted inside each document before anything is shuffled."""
    tokens = spread(df.select(doc, text), doc).select(doc, words(text).alias("__w"))
    return tokens.select(F.explode("__w").alias("term"), doc).groupBy("term", doc).agg(F.count(F.lit(1)).alias("tf"))


def fulltext_search(
    df: DataFrame, doc: str, text: str, must: Sequence[str], phrase: str | None = None, exclude: Sequence[str] = (), k: int = 10
) -> DataFrame:
    """Documents with all terms and the phrase and none of the excluded terms, best share of matches first, with a snippet."""
    tokens = spread(df.select(doc, text), doc).select(doc, text, words(text).alias("__w"))
    cond = F.lit(True)
    for t in must:
        cond = cond & F.array_contains("__w", t)
    for t in exclude:
        cond = cond & ~F.array_contains("__w", t)
    if phrase:
        joined = F.concat(F.lit(" "), F.array_join("__w", " "), F.lit(" "))
        cond = cond & F.contains(joined, F.lit(f" {phrase} "))
    matches = sum((_count(F.col("__w"), t) for t in must), F.lit(0))
    at = F.instr(F.lower(text), must[0])
    headline = F.substring(F.col(text), F.greatest(at - 20, F.lit(1)), F.lit(60))
    found = tokens.where(cond).select(doc, F.round(matches / F.size("__w"), 8).alias("rank_score"), headline.alias("headline"))
    return found.orderBy(F.desc("rank_score"), doc).limit(k)


def chunk_fixed(df: DataFrame, doc: str, text: str, size: int = 200, overlap: int = 40) -> DataFrame:
    """Chunks of `size` words, each repeating the last `overlap` words of the one before."""
    step = size - overlap
    tokens = spread(df.select(doc, text), doc).select(doc, F.filter(F.split(text, r"\s+"), lambda w: w != "").alias("__w"))
    n = F.size("__w")
    chunks = F.greatest(F.lit(1), F.ceil((n - overlap) / step).cast("int"))
    placed = tokens.where(n > 0).select(doc, "__w", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk_no"))
    piece = F.slice("__w", F.col("chunk_no") * step + 1, F.lit(size))
    return placed.select(doc, F.col("chunk_no").cast("bigint").alias("chunk_no"), F.size(piece).cast("bigint").alias("n_words"), F.array_join(piece, " ").alias("chunk"))


def chunk_sentences(df: DataFrame, doc: str, text: str, max_words: int = 120) -> DataFrame:
    """Sentences packed into chunks: a sentence goes to the chunk in whose span of words it starts."""
    sentence = spread(df.select(doc, text), doc).select(doc, F.posexplode(F.split(F.regexp_replace(text, r"([.!?])\s+", "$1\x01"), "\x01")).alias("__pos", "__s"))
    sized = sentence.where(F.trim("__s") != "").withColumn("__n", F.size(F.filter(F.split("__s", r"\s+"), lambda w: w != "")))
    o = running(ordered(sized, [doc], ["__pos"]), {"__before": ("sum", F.col("__n"))}, exclusive=True).result()
    chunk = F.floor(F.coalesce("__before", F.lit(0)) / max_words)
    lines = F.array_sort(F.collect_list(F.struct("__pos", "__s")))  # at most max_words sentences of one word each
    return o.groupBy(doc, chunk.alias("chunk_no")).agg(
        F.count(F.lit(1)).alias("sentences"), F.sum("__n").alias("n_words"), F.array_join(F.transform(lines, lambda x: x["__s"]), " ").alias("chunk"))


def chunk_turns(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Unbroken runs of one speaker, as first turn, number of turns and length."""
    o = shift(ordered(df, [conversation], [turn]), {"__prev": F.col(role)}, [turn])
    o = o.using(o.df.withColumn("__new", (~F.col("__prev").eqNullSafe(F.col(role))).cast("bigint")))
    runs = running(o, {"chunk_no": ("sum", F.col("__new"))}).result()
    return runs.groupBy(conversation, "chunk_no", role).agg(F.min(turn).alias("first_turn"), F.count(F.lit(1)).alias("turns"), F.sum(F.length(text)).cast("bigint").alias("chars"))


def similar_names(df: DataFrame, name: str, threshold: float = 0.5) -> DataFrame:
    """Pairs of distinct names whose trigram similarity reaches the threshold.

    Prefix filter: two such names must share one of their rarest trigrams, so a
    name is looked up under those only and common trigrams never pair anything.
    """
    names = df.select(F.col(name).alias("n")).where("n IS NOT NULL").distinct()
    grams = names.select("n", F.explode(trigrams("n")).alias("g"))
    rarity = grams.groupBy("g").agg(F.count(F.lit(1)).alias("c"))
    ranked = grams.join(rarity, "g").groupBy("n").agg(F.array_sort(F.collect_list(F.struct("c", "g"))).alias("gs"))
    size = F.size("gs")
    prefix = size - F.ceil(F.lit(threshold) * size).cast("int") + 1
    keyed = ranked.select("n", F.explode(F.transform(F.slice("gs", F.lit(1), prefix), lambda x: x["g"])).alias("g"))
    met = keyed.withColumnRenamed("n", "a").join(keyed.withColumnRenamed("n", "b"), "g").where("a < b").select("a", "b").distinct()
    sim = jaccard(trigrams("a"), trigrams("b"))
    return met.select("a", "b", sim.alias("similarity")).where(F.col("similarity") >= threshold)


LICENSES = {  # fixed values: phrases that open common licence texts
    "apache": r"(?i)licensed under the apache license",
    "mit": r"(?i)permission is hereby granted, free of charge|mit license",
    "gpl": r"(?i)gnu (?:lesser |affero )?general public license",
    "bsd": r"(?i)redistribution and use in source and binary forms",
    "other": r"(?i)\blicen[sc]e\b|all rights reserved",
}


def license_scan(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Documents with licence wording, and the first kind that matches."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(LICENSES.items()):
        kind = F.when(F.col(text).rlike(pattern), F.lit(name)).otherwise(kind)
    return spread(df.select(doc, text), doc).select(doc, kind.alias("license")).where("license IS NOT NULL")


def exact_cache(df: DataFrame, request: str, text: str) -> DataFrame:
    """Requests with the same normalised text share one answer: the first request, how many came, how many it saved."""
    key = F.sha2(F.array_join(words(text), " "), 256)
    groups = spread(df.select(request, text), request).groupBy(key.alias("cache_key")).agg(F.min(request).alias("first_request"), F.count(F.lit(1)).alias("requests"))
    return groups.withColumn("hits", F.col("requests") - 1)

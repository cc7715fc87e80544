"""Text, vector, evaluation and feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import udfs as U
from tidewater.functions.dates import day
from tidewater.operators import search_index as I
from tidewater.operators import text as X
from tidewater.operators import vectors as V
from tidewater.operators.control import spread
from tidewater.operators.near_duplicates import near_duplicate_groups
from tidewater.operators.ordered import range_frame
from tidewater.plans.registry import query

TOKENS = r"list_filter(string_split(regexp_replace(lower(text), '[^\p{L} ]', ' ', 'g'), ' '), lambda w: w <> '')"


@query("fulltext_search", f"""WITH d AS (SELECT doc_id, text, {TOKENS} AS w FROM documents)
  SELECT doc_id, round((len(list_filter(w, lambda x: x = 'orre')) + len(list_filter(w, lambda x: x = 'rewh')))::DOUBLE / len(w), 8) AS rank_score, substr(text, greatest(strpos(lower(text), 'orre') - 20, 1), 60) AS headline
  FROM d WHERE list_contains(w, 'orre') AND list_contains(w, 'rewh') AND NOT list_contains(w, 'thatin') AND contains(' ' || array_to_string(w, ' ') || ' ', ' of the ') ORDER BY 2 DESC, 1 LIMIT 10""")
def fulltext_search(t):
    found = I.search(I.index_of(t.documents, "doc_id", "text"), ["orre", "rewh"], "of the", ["thatin"])
    return I.with_headline(found, t.documents, "doc_id", "text", "orre").orderBy(F.desc("rank_score"), "doc_id")


@query("inverted_index", f"SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS}) AS term FROM documents) GROUP BY 1, 2")
def inverted_index(t):
    return X.inverted_index(t.documents, "doc_id", "text")


@query("chunk_fixed", r"""WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM documents),
  c AS (SELECT doc_id, w, unnest(range(greatest(1, ceil((len(w) - 40) / 160.0))::BIGINT)) AS chunk_no FROM d WHERE len(w) > 0)
  SELECT doc_id, chunk_no, len(w[chunk_no * 160 + 1 : chunk_no * 160 + 200]) AS n_words, array_to_string(w[chunk_no * 160 + 1 : chunk_no * 160 + 200], ' ') AS chunk FROM c""")
def chunk_fixed(t):
    return X.chunk_fixed(t.documents, "doc_id", "text")


@query("chunk_structured", r"""WITH s AS (SELECT doc_id, unnest(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))) AS s, unnest(range(len(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))))) AS pos FROM documents),
  n AS (SELECT *, len(list_filter(regexp_split_to_array(s, '\s+'), lambda x: x <> '')) AS n FROM s WHERE trim(s) <> ''),
  b AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // 120 AS chunk_no FROM n)
  SELECT doc_id, chunk_no, count(*) AS sentences, sum(n)::BIGINT AS n_words, string_agg(s, ' ' ORDER BY pos) AS chunk FROM b GROUP BY 1, 2""")
def chunk_structured(t):
    return X.chunk_sentences(t.documents, "doc_id", "text")


@query("chunk_turns", """WITH f AS (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM role THEN 0 ELSE 1 END AS n FROM conversations),
  c AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING)::BIGINT AS chunk_no FROM f)
  SELECT conv_id, chunk_no, role, min(turn) AS first_turn, count(*) AS turns, sum(length(text))::BIGINT AS chars FROM c GROUP BY 1, 2, 3""")
def chunk_turns(t):
    return X.chunk_turns(t.conversations, "conv_id", "turn", "role", "text")


@query("embed_batch")
def embed_batch(t):
    """Vectors of all documents, made in Arrow batches by a replaceable function."""
    return U.in_batches(spread(t.documents.select("doc_id", "text"), "doc_id"), U.hashing_vectors, "doc_id bigint, vector array<double>")


CENTROIDS = """cen AS (SELECT label, list(m ORDER BY pos) AS q FROM (SELECT label, pos, avg(v::DOUBLE) AS m FROM (SELECT label, unnest(embedding) AS v, unnest(range(len(embedding))) AS pos FROM embeddings) GROUP BY 1, 2) GROUP BY 1)"""
KNN = f"""(WITH {CENTROIDS}, s AS (SELECT cen.label::BIGINT AS query, vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q), 6) AS score FROM embeddings, cen),
  r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank FROM s) SELECT query, vec_id, score, rank FROM r)"""


def label_queries(t):
    return V.centroids(t.embeddings, "label", "embedding")


@query("knn_exact", f"SELECT * FROM {KNN} WHERE rank <= 10")
def knn_exact(t):
    return V.knn(t.embeddings, "vec_id", "embedding", label_queries(t), 10)


@query("knn_l2", f"WITH {CENTROIDS}, s AS (SELECT cen.label::BIGINT AS query, vec_id, round(list_distance(embedding::DOUBLE[], q), 6) AS distance FROM embeddings, cen) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, vec_id) AS rank FROM s) WHERE rank <= 10")
def knn_l2(t):
    return V.knn_l2(t.embeddings, "vec_id", "embedding", label_queries(t), 10)


@query("knn_lsh")
def knn_lsh(t):
    return V.knn_lsh(t.embeddings, "vec_id", "embedding", label_queries(t), 10)


SEARCHES = {1: ["rewh", "orre"], 2: ["nicht", "sich", "auf"], 3: ["pour", "dans"]}


def _bm25_sql(limit):
    parts = []
    for q, terms in SEARCHES.items():
        total = " + ".join(
            f"ln((n - (SELECT count(*) FROM d WHERE list_contains(w, '{x}')) + 0.5::DOUBLE) / ((SELECT count(*) FROM d WHERE list_contains(w, '{x}')) + 0.5::DOUBLE) + 1) * len(list_filter(w, lambda y: y = '{x}')) * 2.2::DOUBLE / (len(list_filter(w, lambda y: y = '{x}')) + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len(w) / mean))"
            for x in terms)
        parts.append(f"SELECT {q}::BIGINT AS query, doc_id, round({total}, 8) AS score FROM d, f")
    return f"""(WITH d AS (SELECT doc_id, {TOKENS} AS w FROM documents), f AS (SELECT count(*) AS n, sum(len(w))::DOUBLE / count(*) AS mean FROM d),
      s AS ({" UNION ALL ".join(parts)}), r AS (SELECT query, doc_id, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) SELECT * FROM r WHERE rank <= {limit})"""


@query("bm25", f"SELECT * FROM {_bm25_sql(10)}")
def bm25(t):
    return I.bm25_search(I.index_of(t.documents, "doc_id", "text"), SEARCHES, 10, "doc_id")


@query("hybrid_rrf", f"""WITH a AS (SELECT vec_id AS doc_id, rank FROM {KNN} WHERE query = 0 AND rank <= 100), b AS (SELECT doc_id, rank FROM {_bm25_sql(100)} WHERE query = 1)
  SELECT doc_id, round(coalesce(1.0::DOUBLE / (60 + a.rank), 0) + coalesce(1.0::DOUBLE / (60 + b.rank), 0), 8) AS fused FROM a FULL JOIN b USING (doc_id) ORDER BY 2 DESC, 1 LIMIT 10""")
def hybrid_rrf(t):
    dense = V.knn(t.embeddings, "vec_id", "embedding", {0: label_queries(t)[0]}, 100).withColumnRenamed("vec_id", "doc_id")
    sparse = I.bm25_search(I.index_of(t.documents, "doc_id", "text"), {1: SEARCHES[1]}, 100, "doc_id")
    return V.reciprocal_rank_fusion([dense, sparse], "doc_id", 10)


@query("retrieval_metrics", f"""WITH k AS (SELECT * FROM {KNN} WHERE rank <= 20), rel AS (SELECT label::BIGINT AS query, vec_id FROM embeddings), n AS (SELECT query, count(*) AS relevant FROM rel GROUP BY 1),
  h AS (SELECT query, count(*) AS hits, min(rank) AS first FROM k JOIN rel USING (query, vec_id) GROUP BY 1)
  SELECT query, relevant, coalesce(hits, 0) AS hits, coalesce(hits, 0) / relevant AS recall, coalesce(1.0::DOUBLE / first, 0) AS reciprocal_rank FROM n LEFT JOIN h USING (query)""")
def retrieval_metrics(t):
    got = V.knn(t.embeddings, "vec_id", "embedding", label_queries(t), 20)
    gold = t.embeddings.select(F.col("label").cast("bigint").alias("query"), "vec_id")
    return V.retrieval_metrics(got, gold, "vec_id")


BATTLES = """(SELECT arg_max(l_suppkey, (l_extendedprice, l_suppkey)) AS winner, arg_min(l_suppkey, (l_extendedprice, l_suppkey)) AS loser FROM lineitem GROUP BY l_orderkey HAVING arg_max(l_suppkey, (l_extendedprice, l_suppkey)) <> arg_min(l_suppkey, (l_extendedprice, l_suppkey)))"""


def battles(t):
    """In each order the supplier of the dearest line beats that of the cheapest."""
    at = F.struct("l_extendedprice", "l_suppkey")
    return t.lineitem.groupBy("l_orderkey").agg(F.max_by("l_suppkey", at).alias("winner"), F.min_by("l_suppkey", at).alias("loser")).where("winner <> loser").drop("l_orderkey")


@query("pairwise_winrate", f"SELECT player, count(*) AS games, sum(win)::BIGINT AS wins, sum(win) / count(*) AS win_rate FROM (SELECT winner AS player, 1 AS win FROM {BATTLES} UNION ALL SELECT loser, 0 FROM {BATTLES}) GROUP BY 1")
def pairwise_winrate(t):
    return V.win_rates(battles(t), "winner", "loser")


def _strengths_sql(rounds=6):
    sides = f"SELECT winner AS a, 1 AS win FROM {BATTLES} UNION ALL SELECT loser, 0 FROM {BATTLES}"
    steps = [f"""w AS MATERIALIZED (SELECT a, count(*) AS games, sum(win)::BIGINT AS wins FROM ({sides}) GROUP BY 1)""",
             f"""m AS MATERIALIZED (SELECT least(winner, loser) AS a, greatest(winner, loser) AS b, count(*) AS n FROM {BATTLES} GROUP BY 1, 2)""",
             "x AS MATERIALIZED (SELECT a, b, n FROM m UNION ALL SELECT b, a, n FROM m)", "s0 AS (SELECT a, 1.0::DOUBLE AS s FROM w)"]
    for i in range(1, rounds + 1):
        steps.append(f"r{i} AS MATERIALIZED (SELECT w.a, greatest(any_value(w.wins), 0.5) / sum(x.n / (p.s + o.s)) AS s FROM w JOIN x ON x.a = w.a JOIN s{i - 1} p ON p.a = x.a JOIN s{i - 1} o ON o.a = x.b GROUP BY w.a)")
        steps.append(f"s{i} AS MATERIALIZED (SELECT a, s / (SELECT avg(s) FROM r{i}) AS s FROM r{i})")
    return f"WITH {', '.join(steps)} SELECT w.a AS player, games, wins, round(s, 6) AS strength FROM w JOIN s{rounds} s ON s.a = w.a"


@query("bradley_terry", _strengths_sql())
def bradley_terry(t):
    return V.bradley_terry(battles(t), "winner", "loser")


@query("semantic_cache", f"SELECT sha256(array_to_string({TOKENS}, ' ')) AS cache_key, min(doc_id) AS first_request, count(*) AS requests, count(*) - 1 AS hits FROM documents GROUP BY 1")
def semantic_cache(t):
    return X.exact_cache(t.documents, "doc_id", "text")


@query("semantic_cache_near", f"SELECT query, vec_id AS cached, score FROM {KNN} WHERE rank = 1 AND score >= 0.4")
def semantic_cache_near(t):
    best = V.knn(t.embeddings, "vec_id", "embedding", label_queries(t), 1)
    return best.where("score >= 0.4").select("query", F.col("vec_id").alias("cached"), "score")


@query("near_dup", """WITH n AS (SELECT DISTINCT p_name AS n FROM part), g AS (SELECT n, list_distinct(list_transform(range(1, length(n) + 2), lambda i: substr('  ' || lower(n) || ' ', i::BIGINT, 3))) AS g FROM n),
  p AS (SELECT x.n AS a, y.n AS b, len(list_intersect(x.g, y.g))::DOUBLE / len(list_distinct(list_concat(x.g, y.g))) AS similarity FROM g x JOIN g y ON x.n < y.n) SELECT * FROM p WHERE similarity >= 0.5""")
def near_dup(t):
    return X.similar_names(t.part, "p_name", 0.5)


def _groups_sql(records, threshold):
    """Closure of all similar pairs: by recursion from each id to the smallest one it reaches."""
    return f"""WITH RECURSIVE r AS MATERIALIZED ({records}), g AS MATERIALIZED (SELECT id, list_distinct(list_transform(range(1, length(n) + 2), lambda i: substr('  ' || n || ' ', i::BIGINT, 3))) AS g FROM (SELECT min(id) AS id, n FROM r GROUP BY n)),
  t AS (SELECT id, len(g) AS n, unnest(g) AS t FROM g), s AS (SELECT x.id AS a, y.id AS b, count(*) AS c, any_value(x.n) + any_value(y.n) AS n FROM t x JOIN t y ON x.t = y.t AND x.id < y.id GROUP BY 1, 2),
  p AS MATERIALIZED (SELECT a, b FROM s WHERE c >= {threshold} * (n - c) UNION ALL SELECT b, a FROM s WHERE c >= {threshold} * (n - c)),
  c AS (SELECT id, id AS root FROM g UNION SELECT p.b, c.root FROM c JOIN p ON p.a = c.id WHERE c.root < p.b),
  m AS (SELECT id, min(root) AS root FROM c GROUP BY 1)
  SELECT r.id AS %s, m.root AS group_id FROM r JOIN (SELECT min(id) AS id, n FROM r GROUP BY n) f USING (n) JOIN m ON m.id = f.id"""


@query("near_dup_groups", _groups_sql("SELECT p_partkey AS id, lower(p_name || ' ' || p_brand || ' ' || p_type) AS n FROM part", 0.8) % "p_partkey")
def near_dup_groups(t):
    """Parts whose name, brand and kind are nearly the same."""
    return near_duplicate_groups(t.part, "p_partkey", F.concat_ws(" ", "p_name", "p_brand", "p_type"), 0.8)


@query("near_dup_customers", _groups_sql("SELECT c_custkey AS id, lower(c_mktsegment || ' ' || c_nationkey || ' ' || right(c_name, 7)) AS n FROM customer", 0.8) % "c_custkey")
def near_dup_customers(t):
    """Customers of one segment and nation with nearly the same number."""
    return near_duplicate_groups(t.customer, "c_custkey", F.concat_ws(" ", "c_mktsegment", "c_nationkey", F.right("c_name", F.lit(7))), 0.8)


@query("license_scan", r"""SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)licensed under the apache license') THEN 'apache' WHEN regexp_matches(text, '(?i)permission is hereby granted, free of charge|mit license') THEN 'mit'
  WHEN regexp_matches(text, '(?i)gnu (?:lesser |affero )?general public license') THEN 'gpl' WHEN regexp_matches(text, '(?i)redistribution and use in source and binary forms') THEN 'bsd' ELSE 'other' END AS license
  FROM documents WHERE regexp_matches(text, '(?i)licensed under the apache license|permission is hereby granted, free of charge|mit license|gnu (?:lesser |affero )?general public license|redistribution and use in source and binary forms|\blicen[sc]e\b|all rights reserved')""")
def license_scan(t):
    return X.license_scan(t.documents, "doc_id", "text")


@query("feature_table", """WITH d AS (SELECT user_id, ts::DATE AS d, count(*) AS n, round(sum(value), 2) AS spend, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY 1, 2)
  SELECT user_id, d, last_type, sum(n) OVER w::BIGINT AS events_7d, round(sum(spend) OVER w, 2) AS spend_7d FROM d WINDOW w AS (PARTITION BY user_id ORDER BY d RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""".replace("sum(n) OVER w::BIGINT AS", "(sum(n) OVER w)::BIGINT AS"))
def feature_table(t):
    daily = t.events.groupBy("user_id", day("ts").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("spend"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"))
    framed = range_frame(daily, ["user_id"], F.unix_date("d"), 6, {"events_7d": ("sum", F.col("n")), "s": ("sum", F.col("spend"))})
    return framed.select("user_id", "d", "last_type", "events_7d", F.round("s", 2).alias("spend_7d"))


@query("training_set", """WITH f AS (SELECT user_id, ts, event_id, event_type, count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM events)
  SELECT event_id, user_id, seen, event_type = 'purchase' AS label, CASE WHEN event_id % 5 = 0 THEN 'holdout' ELSE 'train' END AS part FROM f""")
def training_set(t):
    from tidewater.operators.ordered import ordered, running

    e = t.events.select("event_id", "user_id", "ts", "event_type")
    seen = running(ordered(e, ["user_id"], ["ts", "event_id"]), {"seen": ("count", F.lit(1))}, exclusive=True).result()
    return seen.select("event_id", "user_id", "seen", (F.col("event_type") == "purchase").alias("label"), F.when(F.col("event_id") % 5 == 0, "holdout").otherwise("train").alias("part"))


@query("baseline_model")
def baseline_model(t):
    """Features, a hash split, a logistic regression and its measures on the held-out part."""
    from tidewater.operators.models import baseline

    text = F.col("text")
    length = F.length(text)
    features = {
        "log_chars": F.ln(length + 1.0), "digit_share": (length - F.length(F.regexp_replace(text, "[0-9]", ""))) / (length + 1.0),
        "line_share": (length - F.length(F.replace(text, F.lit("\n"), F.lit("")))) / (length + 1.0),
        "symbol_share": (length - F.length(F.regexp_replace(text, r"[^\p{L}\p{N}\s]", ""))) / (length + 1.0),
    }
    joined = spread(t.documents.select("doc_id", "text"), "doc_id").join(t.labels, "doc_id").select("doc_id", F.col("quality").cast("double").alias("label"), *[c.alias(n) for n, c in features.items()])
    return baseline(joined, "doc_id", list(features), "label")


@query("weak_labels", """WITH v AS (SELECT doc_id, (CASE WHEN n_chars > 500 THEN 1 ELSE -1 END) + (CASE WHEN contains(text, '!!!') THEN -1 ELSE 1 END) + (CASE WHEN regexp_matches(text, '[0-9]{6,}') THEN -1 ELSE 1 END) AS votes FROM documents)
  SELECT doc_id, votes::BIGINT AS votes, CASE WHEN votes > 0 THEN 1 ELSE 0 END AS label FROM v""")
def weak_labels(t):
    from tidewater.operators.models import majority

    rules = [F.col("n_chars") > 500, ~F.contains("text", F.lit("!!!")), ~F.col("text").rlike("[0-9]{6,}")]
    return majority(t.documents, "doc_id", rules)

"""Independent SQL (DuckDB dialect) for the catalogue queries that have an exact answer.

Written directly from the definitions with plain window functions and joins, over the
driver's registered views. Queries whose answer depends on file names, time or an
iterative fit (ALS) have no entry and are checked by row count only.
"""

from __future__ import annotations

# Doubles are rounded as floor(x * 1e9 + 0.5) / 1e9 on both sides: the same formula
# gives the same bits in both engines, unlike the two engines' own round().

CUST = """
cust AS (
  SELECT o.o_custkey AS basket, l.l_partkey AS item,
         CAST(row_number() OVER (PARTITION BY o.o_custkey
              ORDER BY o.o_orderdate, o.o_orderkey, l.l_linenumber, l.l_partkey) - 1 AS INTEGER) AS position
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

ORDER = """
ord AS (
  SELECT l_orderkey AS basket, l_partkey AS item,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1 AS INTEGER) AS position
  FROM lineitem)"""

SUPP = """
supp AS (
  SELECT l_suppkey AS basket, l_partkey AS item,
         CAST(row_number() OVER (PARTITION BY l_suppkey
              ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) - 1 AS INTEGER) AS position
  FROM lineitem)"""

EVT = """
evt AS (
  SELECT user_id AS basket, event_type AS item,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INTEGER) AS position
  FROM events)"""

MIX = """
mix AS (
  SELECT 3 * l_orderkey AS basket, l_partkey AS item FROM lineitem
  UNION ALL
  SELECT 3 * o.o_custkey + 1 AS basket, l.l_partkey AS item
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  UNION ALL
  SELECT 3 * l_suppkey + 2 AS basket, l_partkey AS item FROM lineitem),
sizes AS (SELECT basket, count(item) AS basket_size FROM mix GROUP BY basket),
bands AS (
  SELECT basket, basket_size,
         CASE WHEN basket_size BETWEEN 5 AND 20 THEN 'small'
              WHEN basket_size BETWEEN 21 AND 100 THEN 'medium'
              WHEN basket_size >= 101 THEN 'large' END AS band
  FROM sizes)"""

SPLIT = CUST + """,
split AS (
  SELECT basket, item, position,
         row_number() OVER (PARTITION BY basket ORDER BY position, item) AS split_rank,
         count(*) OVER (PARTITION BY basket) AS basket_size
  FROM cust),
train AS (SELECT basket, item, position FROM split WHERE split_rank <= basket_size * 0.8::DOUBLE),
test AS (SELECT basket, item, position FROM split WHERE split_rank > basket_size * 0.8::DOUBLE)"""


def _hash(keys: str) -> str:
    """First 8 hex digits of md5('42:k1:k2') as an integer (same as the Spark side)."""
    return f"('0x' || substr(md5(concat_ws(':', '42', {keys})), 1, 8))::BIGINT"


def _keep(fraction: str, keys: str) -> str:
    return f"{_hash(keys)} < ({fraction}) * 4294967296.0"


STRATA = """CASE band WHEN 'small' THEN 0.4::DOUBLE WHEN 'medium' THEN 0.6::DOUBLE
                    WHEN 'large' THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END"""

FALLBACK = """
fallback AS (
  SELECT item, count(basket) AS frequency, count(DISTINCT basket) AS unique_baskets,
         count(basket) + count(DISTINCT basket) * 0.5::DOUBLE AS popularity_score
  FROM train GROUP BY item),
ranked AS (
  SELECT item, popularity_score, row_number() OVER (ORDER BY popularity_score DESC, item) AS cand_rank
  FROM fallback)"""

POPULARITY = """
rated AS (
  SELECT basket, item, position, greatest(1.0::DOUBLE, 5.0::DOUBLE - ln(position + 1)) AS implicit_rating
  FROM train),
feats AS (
  SELECT item, count(basket) AS frequency, count(DISTINCT basket) AS unique_baskets,
         avg(implicit_rating) AS avg_rating,
         CAST(sum(CASE WHEN position < 5 THEN 1 ELSE 0 END) AS BIGINT) AS early_position_count,
         avg(position) AS avg_position, stddev_samp(position) AS stddev_position
  FROM rated GROUP BY item),
pop AS (
  SELECT item, frequency, unique_baskets, avg_rating, early_position_count,
         coalesce(avg_position, 0.0::DOUBLE) AS avg_position,
         coalesce(stddev_position, 0.0::DOUBLE) AS stddev_position,
         coalesce(frequency::DOUBLE / (SELECT max(frequency) FROM feats) * 0.25::DOUBLE
                  + unique_baskets::DOUBLE / (SELECT max(unique_baskets) FROM feats) * 0.35::DOUBLE
                  + avg_rating / 5.0::DOUBLE * 0.25::DOUBLE
                  + early_position_count::DOUBLE / frequency * 0.15::DOUBLE, 0.0::DOUBLE) AS popularity_score
  FROM feats)"""

RECS = SPLIT + "," + FALLBACK + """,
seen AS (SELECT DISTINCT basket, item FROM train),
held AS (SELECT s.basket, count(*) AS m FROM seen s JOIN ranked r ON s.item = r.item GROUP BY s.basket),
bk AS (
  SELECT t.basket, coalesce(h.m, 0) AS m
  FROM (SELECT DISTINCT basket FROM test) t LEFT JOIN held h ON t.basket = h.basket),
slots AS (
  SELECT bk.basket, r.item, r.cand_rank
  FROM bk JOIN ranked r ON r.cand_rank <= 100 + bk.m
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.basket = bk.basket AND s.item = r.item)),
recs AS (
  SELECT basket, item, rank FROM (
    SELECT basket, item, row_number() OVER (PARTITION BY basket ORDER BY cand_rank) AS rank FROM slots)
  WHERE rank <= 100),
truth AS (SELECT DISTINCT basket, item FROM test),
hits AS (SELECT r.basket, r.item, r.rank FROM recs r JOIN truth t ON r.basket = t.basket AND r.item = t.item),
ap AS (
  SELECT basket, sum(i::DOUBLE / rank) / count(*) AS ap FROM (
    SELECT basket, rank, row_number() OVER (PARTITION BY basket ORDER BY rank) AS i FROM hits WHERE rank <= 100)
  GROUP BY basket),
aps AS (
  SELECT b.basket, coalesce(ap.ap, 0.0::DOUBLE) AS average_precision
  FROM (SELECT DISTINCT basket FROM test) b LEFT JOIN ap ON b.basket = ap.basket),
mapv AS (
  SELECT avg(average_precision) AS map, count(basket) AS baskets,
         count(*) FILTER (WHERE average_precision > 0) AS baskets_with_hits FROM aps)"""

REQUESTS = SPLIT + """,
req AS (SELECT basket, position // 256 AS c, count(*) AS n FROM test GROUP BY basket, c),
docs AS (SELECT DISTINCT basket // 32 AS d, c FROM req)"""

HYBRID = SPLIT + "," + FALLBACK + "," + POPULARITY + """,
model AS (
  SELECT item, cand_rank, popularity_score / (SELECT max(popularity_score) FROM fallback) AS model_score
  FROM ranked),
held AS (SELECT basket, count(DISTINCT item) AS m FROM train GROUP BY basket),
cands AS (
  SELECT b.basket, m.item, m.model_score, coalesce(floor(p.popularity_score * 4294967296.0 + 0.5) / 4294967296.0, 0.0::DOUBLE)
         AS popularity_score
  FROM (SELECT DISTINCT basket FROM test) b LEFT JOIN held h ON h.basket = b.basket
  JOIN model m ON m.cand_rank <= 100 + coalesce(h.m, 0)
  LEFT JOIN pop p ON p.item = m.item),
blended AS (
  SELECT basket, item, model_score, popularity_score,
         model_score * 0.7::DOUBLE + popularity_score * 0.3::DOUBLE AS final_score
  FROM cands c
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.basket = c.basket AND t.item = c.item)),
hybrid AS (
  SELECT * FROM (
    SELECT basket, item, model_score, popularity_score, final_score,
           row_number() OVER (PARTITION BY basket ORDER BY final_score DESC, item) AS rank
    FROM blended) WHERE rank <= 100)"""


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


ORACLE: dict[str, str] = {
    "interactions": _with(CUST, "SELECT basket, item, position FROM cust"),
    "basket_index": _with(CUST, """
        SELECT basket, CAST(row_number() OVER (ORDER BY basket) - 1 AS INTEGER) AS basket_idx
        FROM (SELECT DISTINCT basket FROM cust)"""),
    "item_index": _with(CUST, """
        SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS item_idx
        FROM (SELECT DISTINCT item FROM cust)"""),
    "indexed_interactions": _with(CUST + """,
        bidx AS (SELECT basket, CAST(row_number() OVER (ORDER BY basket) - 1 AS INTEGER) AS basket_idx
                 FROM (SELECT DISTINCT basket FROM cust)),
        iidx AS (SELECT item, CAST(row_number() OVER (ORDER BY item) - 1 AS INTEGER) AS item_idx
                 FROM (SELECT DISTINCT item FROM cust))""", """
        SELECT b.basket_idx, i.item_idx, c.item, c.position
        FROM cust c JOIN bidx b ON c.basket = b.basket JOIN iidx i ON c.item = i.item"""),
    "split_train": _with(SPLIT, "SELECT basket, item, position FROM train"),
    "split_test": _with(SPLIT, "SELECT basket, item, position FROM test"),
    "split_order": _with(ORDER, """
        SELECT basket, item, position, split_rank, basket_size,
               split_rank <= basket_size * 0.8::DOUBLE AS is_train
        FROM (SELECT basket, item, position,
                     row_number() OVER (PARTITION BY basket ORDER BY position, item) AS split_rank,
                     count(*) OVER (PARTITION BY basket) AS basket_size
              FROM ord)"""),
    "split_supp": _with(SUPP, """
        SELECT basket, item, position, split_rank, basket_size,
               split_rank <= basket_size * 0.8::DOUBLE AS is_train
        FROM (SELECT basket, item, position,
                     row_number() OVER (PARTITION BY basket ORDER BY position, item) AS split_rank,
                     count(*) OVER (PARTITION BY basket) AS basket_size
              FROM supp)"""),
    "null_keys": """
        SELECT count(*) FILTER (WHERE c_custkey IS NULL) AS null_basket,
               count(*) FILTER (WHERE l_partkey IS NULL) AS null_item, count(*) AS rows
        FROM customer FULL JOIN (SELECT o_custkey, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
             ON c_custkey = o_custkey""",
    "implicit_rating": _with(SPLIT, """
        SELECT basket, item, position,
               (floor((greatest(1.0::DOUBLE, 5.0::DOUBLE - ln(position + 1))) * 1e9 + 0.5) / 1e9) AS implicit_rating
        FROM train"""),
    "basket_sizes": _with(MIX, "SELECT basket, basket_size FROM sizes"),
    "size_bands": _with(MIX, "SELECT basket, basket_size, band FROM bands WHERE band IS NOT NULL"),
    "stratified_sample": _with(MIX, f"""
        SELECT basket, basket_size, band FROM bands
        WHERE band IS NOT NULL AND {_keep(STRATA, 'CAST(basket AS VARCHAR)')}"""),
    "stratified_interactions": _with(SPLIT + """,
        tsizes AS (SELECT basket, count(item) AS basket_size FROM train GROUP BY basket),
        tbands AS (SELECT basket, basket_size,
                   CASE WHEN basket_size BETWEEN 5 AND 20 THEN 'small'
                        WHEN basket_size BETWEEN 21 AND 100 THEN 'medium'
                        WHEN basket_size >= 101 THEN 'large' END AS band FROM tsizes)""", f"""
        SELECT basket, item, position FROM train
        WHERE basket IN (SELECT basket FROM tbands
                         WHERE band IS NOT NULL AND {_keep(STRATA, 'CAST(basket AS VARCHAR)')})"""),
    "row_sample": _with(SPLIT, f"""
        SELECT basket, item, position FROM train
        WHERE {_keep('0.3::DOUBLE', 'CAST(basket AS VARCHAR), CAST(position AS VARCHAR)')}"""),
    "popularity_features": _with(SPLIT + "," + POPULARITY, """
        SELECT item, frequency, unique_baskets, (floor((avg_rating) * 1e9 + 0.5) / 1e9) AS avg_rating, early_position_count,
               (floor((avg_position) * 1e9 + 0.5) / 1e9) AS avg_position, (floor((stddev_position) * 1e9 + 0.5) / 1e9) AS stddev_position
        FROM pop"""),
    "popularity_score": _with(SPLIT + "," + POPULARITY,
                              "SELECT item, (floor((popularity_score) * 1e9 + 0.5) / 1e9) AS popularity_score FROM pop"),
    "cooccurrence": _with(SPLIT + f""",
        capped AS (SELECT basket FROM train GROUP BY basket HAVING count(item) BETWEEN 5 AND 200),
        kept AS (SELECT basket, item FROM train
                 WHERE basket IN (SELECT basket FROM capped)
                   AND {_keep('0.3::DOUBLE', 'CAST(basket AS VARCHAR), CAST(position AS VARCHAR)')})""", """
        SELECT a.item AS item1, b.item AS item2, count(*) AS cooccur_count
        FROM kept a JOIN kept b ON a.basket = b.basket AND a.item < b.item
        GROUP BY a.item, b.item HAVING count(*) >= 3"""),
    "cooccurrence_full": _with(SPLIT + """,
        capped AS (SELECT basket FROM train GROUP BY basket HAVING count(item) BETWEEN 5 AND 200),
        kept AS (SELECT basket, item FROM train WHERE basket IN (SELECT basket FROM capped))""", """
        SELECT a.item AS item1, b.item AS item2, count(*) AS cooccur_count
        FROM kept a JOIN kept b ON a.basket = b.basket AND a.item < b.item
        GROUP BY a.item, b.item HAVING count(*) >= 3"""),
    "cooccurrence_dups": _with(EVT + """,
        capped AS (SELECT basket FROM evt GROUP BY basket HAVING count(item) BETWEEN 5 AND 200),
        kept AS (SELECT basket, item FROM evt WHERE basket IN (SELECT basket FROM capped))""", """
        SELECT a.item AS item1, b.item AS item2, count(*) AS cooccur_count
        FROM kept a JOIN kept b ON a.basket = b.basket AND a.item < b.item
        GROUP BY a.item, b.item HAVING count(*) >= 3"""),
    "fallback_popularity": _with(SPLIT + "," + FALLBACK,
                                 "SELECT item, frequency, unique_baskets, popularity_score FROM fallback"),
    "top_candidates": _with(SPLIT + "," + FALLBACK,
                            "SELECT item, popularity_score, cand_rank FROM ranked"),
    "recs_unseen": _with(RECS, "SELECT basket, item, rank FROM recs"),
    "hybrid_rank": _with(HYBRID, """
        SELECT basket, item, (floor((model_score) * 1e9 + 0.5) / 1e9) AS model_score,
               (floor((popularity_score) * 1e9 + 0.5) / 1e9) AS popularity_score,
               (floor((final_score) * 1e9 + 0.5) / 1e9) AS final_score, rank FROM hybrid"""),
    "rec_scores": _with(HYBRID, """
        SELECT item, (floor((avg(final_score)) * 1e9 + 0.5) / 1e9) AS popularity_score, count(basket) AS frequency
        FROM hybrid GROUP BY item"""),
    "hits": _with(RECS, "SELECT basket, item, rank FROM hits"),
    "metrics_at_k": _with(RECS + """,
        ks AS (SELECT unnest([10, 20, 50, 100]) AS k),
        nb AS (SELECT count(DISTINCT basket) AS n FROM test),
        nt AS (SELECT count(*) AS n FROM truth)""", """
        SELECT CAST(ks.k AS INTEGER) AS k, count(h.rank) AS hits,
               (floor((count(h.rank)::DOUBLE / ((SELECT n FROM nb) * ks.k)) * 1e9 + 0.5) / 1e9) AS precision,
               (floor((count(h.rank)::DOUBLE / (SELECT n FROM nt)) * 1e9 + 0.5) / 1e9) AS recall,
               (floor((count(DISTINCT h.basket)::DOUBLE / (SELECT n FROM nb)) * 1e9 + 0.5) / 1e9) AS coverage
        FROM ks LEFT JOIN hits h ON h.rank <= ks.k
        GROUP BY ks.k"""),
    "average_precision": _with(RECS, "SELECT basket, (floor((average_precision) * 1e9 + 0.5) / 1e9) AS average_precision FROM aps"),
    "map_at_100": _with(RECS, "SELECT (floor((map) * 1e9 + 0.5) / 1e9) AS map, baskets, baskets_with_hits FROM mapv"),
    "quality_tier": _with(RECS, """
        SELECT (floor((map) * 1e9 + 0.5) / 1e9) AS map,
               (floor((CASE WHEN map > 0.005 THEN (map - 0.005) / 0.005 * 100.0 END) * 1e6 + 0.5) / 1e6) AS improvement,
               CASE WHEN map > 0.020 THEN 'EXCELLENT' WHEN map > 0.015 THEN 'VERY GOOD'
                    WHEN map > 0.010 THEN 'GOOD' WHEN map > 0.005 THEN 'ACCEPTABLE'
                    ELSE 'NEEDS IMPROVEMENT' END AS tier
        FROM mapv"""),
    "evaluation_report": _with(RECS + """,
        ks AS (SELECT unnest([10, 20, 50, 100]) AS k),
        nb AS (SELECT count(DISTINCT basket) AS n FROM test),
        nt AS (SELECT count(*) AS n FROM truth)""", """
        SELECT CAST(ks.k AS INTEGER) AS k, count(h.rank) AS hits,
               (floor((count(h.rank)::DOUBLE / ((SELECT n FROM nb) * ks.k)) * 1e9 + 0.5) / 1e9) AS precision,
               (floor((count(h.rank)::DOUBLE / (SELECT n FROM nt)) * 1e9 + 0.5) / 1e9) AS recall,
               (floor((count(DISTINCT h.basket)::DOUBLE / (SELECT n FROM nb)) * 1e9 + 0.5) / 1e9) AS coverage,
               (floor(((SELECT map FROM mapv)) * 1e9 + 0.5) / 1e9) AS map_at_100,
               (floor((CASE WHEN (SELECT map FROM mapv) > 0.005
                            THEN ((SELECT map FROM mapv) - 0.005) / 0.005 * 100.0 END) * 1e6 + 0.5) / 1e6)
                 AS improvement,
               CASE WHEN (SELECT map FROM mapv) > 0.020 THEN 'EXCELLENT'
                    WHEN (SELECT map FROM mapv) > 0.015 THEN 'VERY GOOD'
                    WHEN (SELECT map FROM mapv) > 0.010 THEN 'GOOD'
                    WHEN (SELECT map FROM mapv) > 0.005 THEN 'ACCEPTABLE'
                    ELSE 'NEEDS IMPROVEMENT' END AS tier
        FROM ks LEFT JOIN hits h ON h.rank <= ks.k
        GROUP BY ks.k"""),
    "dataset_stats": _with(SPLIT, """
        SELECT count(DISTINCT basket) AS baskets, count(DISTINCT item) AS items, count(*) AS interactions,
               count(*) FILTER (WHERE split_rank <= basket_size * 0.8::DOUBLE) AS train_rows,
               count(*) FILTER (WHERE split_rank > basket_size * 0.8::DOUBLE) AS test_rows
        FROM split"""),
    "distinct_sketches": _with(SPLIT, """
        SELECT count(DISTINCT basket) AS baskets, count(DISTINCT item) AS items, count(*) AS rows,
               true AS union_near_one_pass, true AS within_error
        FROM split"""),
    "submission_rows": _with(RECS, """
        SELECT CAST(basket AS VARCHAR) AS playlist_id,
               CAST(to_json(list(CAST(item AS VARCHAR) ORDER BY rank)) AS VARCHAR) AS recommended_tracks,
               count(*) AS total_recommendations
        FROM recs GROUP BY basket"""),
    "nested_parse": _with(ORDER, "SELECT basket, 'item:' || CAST(item AS VARCHAR) AS item, position FROM ord"),
    # every request stands twice; each document ends with one empty request
    "root_shapes": _with(REQUESTS, """
        SELECT CASE WHEN basket % 7 <> 0 THEN CAST(basket AS VARCHAR) END AS test_id,
               CAST(2 * count(*) AS BIGINT) AS requests,
               CAST(1 AS BIGINT) AS names, CAST(2 * sum(n) AS BIGINT) AS items
        FROM req WHERE basket % 7 <> 0 GROUP BY basket
        UNION ALL
        SELECT NULL, 2 * count(*) + (SELECT count(*) FROM docs), 2 * count(*) + (SELECT count(*) FROM docs),
               CAST(2 * sum(n) AS BIGINT)
        FROM req WHERE basket % 7 = 0"""),
    "request_lists": _with(REQUESTS + "," + FALLBACK + """,
        wanted AS (SELECT basket, c, count(DISTINCT t.item) FILTER (WHERE f.item IS NOT NULL) AS held
                   FROM (SELECT basket, position // 256 AS c, item FROM test) t LEFT JOIN fallback f USING (item)
                   GROUP BY basket, c),
        n AS (SELECT count(*) AS items FROM fallback)""", """
        SELECT CAST(2 * (SELECT count(*) FROM req) + (SELECT count(*) FROM docs) AS BIGINT) AS total_playlists,
               CAST(2 * (SELECT count(*) FROM req) + (SELECT count(*) FROM docs) AS BIGINT) AS read_back,
               'popularity' AS model_type, CAST(100 AS BIGINT) AS recommendations_per_playlist,
               CAST(2 * (SELECT sum(least(100, (SELECT items FROM n) - held)) FROM wanted)
                    + (SELECT count(*) FROM docs) * least(100, (SELECT items FROM n)) AS BIGINT) AS items,
               CAST(2 * (SELECT count(*) FROM req) + (SELECT count(*) FROM docs) AS BIGINT) AS keys"""),
    "nested_parse_multiline": _with(ORDER, "SELECT basket, 'item:' || CAST(item AS VARCHAR) AS item, position FROM ord"),
    "file_sample": _with(ORDER, f"""
        SELECT basket, 'item:' || CAST(item AS VARCHAR) AS item, position FROM ord
        WHERE {_keep('0.5::DOUBLE', 'CAST(basket AS VARCHAR)')}"""),
    "file_inventory": """
        SELECT o_orderpriority AS folder, CAST(1 AS BIGINT) AS files,
               CAST(sum(strlen(CAST(o_orderkey AS VARCHAR)) + 1) AS BIGINT) AS bytes
        FROM orders GROUP BY o_orderpriority""",
    "file_listing": """
        SELECT o_orderpriority AS folder, count(DISTINCT o_orderkey % 3) AS files, true AS in_order
        FROM orders GROUP BY o_orderpriority""",
    "file_level_sample": _with(ORDER, f"""
        SELECT basket, 'item:' || CAST(item AS VARCHAR) AS item, position FROM ord
        WHERE {_keep('0.5::DOUBLE', 'CAST(basket // 1024 AS VARCHAR)')}"""),
    "stage_snapshots": _with(SPLIT, """
        SELECT f AS frame, count(*) AS rows, CAST(sum(item) AS BIGINT) AS items, CAST(2 AS BIGINT) AS versions
        FROM train, (SELECT unnest(['held', 'interrupted', 'current']) AS f)
        WHERE f <> 'current' OR basket % 2 = 0 GROUP BY f"""),
    "model_round_trip": _with(SPLIT, """
        SELECT count(DISTINCT basket) AS baskets, count(DISTINCT item) AS items, CAST(50 AS BIGINT) AS rank,
               count(DISTINCT basket) AS same_baskets, count(DISTINCT item) AS same_items
        FROM train"""),
    "ingest_increment": _with(ORDER, """
        SELECT count(DISTINCT basket) AS baskets, count(*) AS interactions, CAST(1 AS BIGINT) AS failed,
               CAST(0 AS BIGINT) AS new_files, CAST(0 AS BIGINT) AS new_baskets, count(*) AS held
        FROM ord"""),
    "stage_tables": _with(SPLIT, """
        SELECT 'once' AS stage, count(*) AS rows, CAST(sum(item) AS BIGINT) AS items FROM train
        UNION ALL SELECT 'fallback', count(*), CAST(sum(item) AS BIGINT) FROM train
        UNION ALL SELECT 'twice', 2 * count(*), CAST(2 * sum(item) AS BIGINT) FROM train
        UNION ALL SELECT 'part 1', count(*), CAST(sum(item) AS BIGINT) FROM train WHERE basket % 3 = 1"""),
    "truth_pairs": _with(RECS, "SELECT basket, item FROM truth WHERE basket IN (SELECT basket FROM recs)"),
    "cooccurrence_supp": _with(SUPP + """,
        folded AS (SELECT basket, item, count(*) AS n FROM supp GROUP BY basket, item),
        kept AS (SELECT basket FROM supp GROUP BY basket HAVING count(item) >= 5)""", """
        SELECT a.item AS item1, b.item AS item2, CAST(sum(a.n * b.n) AS BIGINT) AS cooccur_count
        FROM folded a JOIN folded b ON a.basket = b.basket AND a.item < b.item
        WHERE a.basket IN (SELECT basket FROM kept) GROUP BY a.item, b.item HAVING sum(a.n * b.n) >= 3"""),
    "cooccurrence_supp_all": _with(SUPP + """,
        folded AS (SELECT basket, item, count(*) AS n FROM supp GROUP BY basket, item),
        kept AS (SELECT basket FROM supp GROUP BY basket HAVING count(item) >= 5)""", """
        SELECT a.item AS item1, b.item AS item2, CAST(sum(a.n * b.n) AS BIGINT) AS cooccur_count
        FROM folded a JOIN folded b ON a.basket = b.basket AND a.item < b.item
        WHERE a.basket IN (SELECT basket FROM kept) GROUP BY a.item, b.item HAVING sum(a.n * b.n) >= 3"""),
    "excluded_baskets": _with(MIX, """
        SELECT count(*) FILTER (WHERE basket_size < 5) AS small_baskets,
               CAST(coalesce(sum(basket_size) FILTER (WHERE basket_size < 5), 0) AS BIGINT) AS small_rows,
               count(*) FILTER (WHERE basket_size > 200) AS large_baskets,
               CAST(coalesce(sum(basket_size) FILTER (WHERE basket_size > 200), 0) AS BIGINT) AS large_rows
        FROM sizes"""),
    "als_candidates": _with(SPLIT, """
        SELECT b.basket, CASE WHEN b.basket IN (SELECT basket FROM train) THEN least(100, n) ELSE 0 END AS listed,
               CASE WHEN b.basket IN (SELECT basket FROM train) THEN least(100, n) ELSE 0 END AS items
        FROM (SELECT DISTINCT basket FROM test) b, (SELECT count(DISTINCT item) AS n FROM train)"""),
    "als_hybrid_eval": _with(SPLIT + """,
        known AS (SELECT t.basket, count(DISTINCT s.item) AS m FROM (SELECT DISTINCT basket FROM test) t
                  JOIN train s USING (basket) GROUP BY t.basket),
        n AS (SELECT count(DISTINCT item) AS items FROM train)""", """
        SELECT CAST(k AS INTEGER) AS k, true AS in_bounds, true AS fitted, (SELECT count(DISTINCT basket) FROM test) AS baskets,
               (SELECT count(*) FROM known, n WHERE m < items) AS baskets_with_recs,
               (SELECT count(*) FROM (SELECT DISTINCT basket, item FROM test)) AS held_out,
               (SELECT CAST(sum(least(100, items - m)) AS BIGINT) FROM known, n) AS listed,
               CAST(0 AS BIGINT) AS seen_listed
        FROM (SELECT unnest([10, 20, 50, 100]) AS k)"""),
    "als_fit": _with(SPLIT, """
        SELECT count(*) AS ratings, true AS falls, true AS fitted, true AS penalised,
               floor(sum(1 + greatest(1.0::DOUBLE, 5.0::DOUBLE - ln(position + 1))) * 1e3 + 0.5) / 1e3 AS null_loss
        FROM train"""),
    "als_search": _with(SPLIT, """
        SELECT count(DISTINCT t.basket) AS baskets, any_value(n) AS items, count(DISTINCT t.basket) * any_value(n) AS pairs,
               true AS within, true AS first_block
        FROM (SELECT DISTINCT basket FROM test) t JOIN train USING (basket), (SELECT count(DISTINCT item) AS n FROM train)"""),
    "run_metadata": _with(SPLIT + """,
        capped AS (SELECT basket FROM train GROUP BY basket HAVING count(item) BETWEEN 5 AND 200),
        kept AS (SELECT basket, item FROM train WHERE basket IN (SELECT basket FROM capped)),
        pairs AS (SELECT a.item, b.item FROM kept a JOIN kept b ON a.basket = b.basket AND a.item < b.item
                  GROUP BY a.item, b.item HAVING count(*) >= 3)""", """
        SELECT 'hybrid_als_popularity' AS model_type, CAST(50 AS BIGINT) AS als_rank, 0.01::DOUBLE AS als_reg,
               1.0::DOUBLE AS als_alpha, count(DISTINCT basket) AS sample_baskets, count(*) AS sample_interactions,
               count(DISTINCT item) AS total_items, (SELECT count(*) FROM pairs) AS similarities_count
        FROM train"""),
}

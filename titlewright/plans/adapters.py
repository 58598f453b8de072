"""Titles, votes and golden labels derived from the documents table, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titlewright.functions import dims



def _values(rows: list[tuple]) -> str:
    """Rows of SQL; numbers with a fraction as doubles in both dialects."""
    text = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else f"{x!r}E0" if isinstance(x, float) else str(x)
    return ", ".join(f"({', '.join(map(text, r))})" for r in rows)


_IDS = {name: i for i, name in dims.MOVIE_GENRES.items()}
_GENRES = [(i, name, _IDS[name], float(dims.RARITY[name])) for i, name in enumerate(dims.PRIMARY)]
_LABELS = [(i, name, *(("subgenres", 0.7) if i < len(dims.SUBGENRES) else ("thematic", 0.55))) for i, name in enumerate(dims.SUBGENRES + dims.THEMATIC)]
_MOODS = list(enumerate(dims.MOODS))
_GROUNDING = ("police procedural", "heist", "serial killer", "spy/espionage", "assassin/hitman", "time travel", "cyberpunk", "zombie", "slasher", "superhero", "coming-of-age", "martial arts", "biopic", "mockumentary")
_KEYWORDS = [(i, *k) for i, k in enumerate([(k, name) for name in _GROUNDING for k in dims.GROUNDING[name]] + [(dims.ANIME_KEYWORD, "")])]

#: Common table expressions; to be put after WITH. They read the table documents.
ADAPTERS = f"""
genre_dim(gi, genre, genre_id, w) AS (SELECT * FROM (VALUES {_values(_GENRES)}) AS a(gi, genre, genre_id, w)),
label_dim(li, label, family, thr) AS (SELECT * FROM (VALUES {_values(_LABELS)}) AS a(li, label, family, thr)),
mood_dim(mi, mood) AS (SELECT * FROM (VALUES {_values(_MOODS)}) AS a(mi, mood)),
kw_dim(ki, keyword_id, grounds) AS (SELECT * FROM (VALUES {_values(_KEYWORDS)}) AS a(ki, keyword_id, grounds)),
three(k) AS (SELECT a.k FROM (VALUES (0),(1),(2)) AS a(k)),
titles AS (SELECT doc_id AS tmdb_id, CASE WHEN doc_id % 4 = 3 THEN 'tv' ELSE 'movie' END AS media_type,
 concat('Title ', CAST(doc_id AS STRING)) AS title, CAST(1920 + doc_id % 107 AS INT) AS year,
 CASE WHEN doc_id % 29 = 0 THEN '  stub  ' ELSE text END AS overview,
 CASE WHEN lang = 'de' THEN 'ja' ELSE lang END AS original_language, upper(lang) AS origin_country,
 (doc_id * 37) % 400 AS vote_count FROM documents),
title_genres AS (SELECT t.tmdb_id, p.k AS pos, g.genre_id, g.genre FROM titles t CROSS JOIN three p
 JOIN genre_dim g ON g.gi = (t.tmdb_id * 3 + p.k * 5) % 18),
title_keywords AS (SELECT t.tmdb_id, p.k AS pos, d.keyword_id, d.grounds FROM titles t CROSS JOIN three p
 JOIN kw_dim d ON d.ki = (t.tmdb_id * 3 + p.k * 7) % 24),
votes AS (SELECT t.tmdb_id, p.k + 1 AS pass, (t.tmdb_id * 3 + (p.k + 1) * (t.tmdb_id % 4)) % 19 AS gi
 FROM titles t CROSS JOIN three p WHERE t.tmdb_id % 31 <> 30 AND (p.k = 0 OR (t.tmdb_id * 7 + p.k + 1) % 3 <> 0)),
vote_items AS (SELECT v.tmdb_id, v.pass, p.k AS pos, (v.tmdb_id * 5 + v.pass * (v.tmdb_id % 3) + p.k * 11) % 50 AS li,
 CAST((v.tmdb_id * 13 + v.pass * 17 + p.k * 7) % 60 + 40 AS DOUBLE) / 100 AS conf
 FROM votes v CROSS JOIN three p WHERE v.tmdb_id % 17 <> 0),
vote_moods AS (SELECT v.tmdb_id, v.pass, p.k AS pos, (v.tmdb_id * 11 + p.k * 5) % 16 AS mi,
 CAST((v.tmdb_id * 17 + v.pass * 5 + p.k * 3) % 50 + 45 AS DOUBLE) / 100 AS conf FROM votes v CROSS JOIN three p),
golden AS (SELECT tmdb_id, ((tmdb_id * 3 + tmdb_id % 4) % 19) % 18 AS gi, ((tmdb_id * 5 + tmdb_id % 3) % 50) % 48 AS li1, (tmdb_id * 5 + 11) % 48 AS li2,
 (tmdb_id * 11) % 14 AS mi FROM titles WHERE tmdb_id % 10 < 4)
"""


def adapted(spark: SparkSession, sf_dir: str, query: str) -> DataFrame:
    """The result of a query over the adapters' tables."""
    text = ("WITH " + ADAPTERS).replace("FROM documents", "FROM {documents}") + query
    return spark.sql(text, documents=spark.read.parquet(f"{sf_dir}/documents.parquet"))

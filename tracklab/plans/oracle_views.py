"""SQL text of the views the oracle queries start from."""

from __future__ import annotations

from urllib.parse import quote

from tracklab import schema as S
from tracklab.sources.tables import genre_dim_rows


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(rows) -> str:
    def cell(v):
        return text(v) if isinstance(v, str) else str(v)
    return "VALUES " + ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


GENRE_DIM = f"genre_dim(gid, raw_label) AS ({values(genre_dim_rows())})"
TAXONOMY = f"taxonomy(raw, super_genre) AS ({values(sorted(S.RAW_TO_CLASS.items()))})"
TRACKS = """base AS (SELECT
 concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), CAST(CAST(floor(l_extendedprice*100) AS BIGINT) AS STRING)) AS track_id,
 o_custkey AS artist_key, l_partkey % 116 AS gid, p_name AS track_name,
 CAST(floor(l_quantity*2) AS INT) AS popularity,
 CAST(floor(l_extendedprice*4*(CASE WHEN l_orderkey % 97 = 0 THEN 20 ELSE 1 END)) AS BIGINT) AS duration_ms,
 (l_linestatus = 'F') AS explicit,
 l_discount*10 AS danceability, p_size/50 AS energy, CAST(l_partkey % 12 AS INT) AS key,
 0 - l_extendedprice/2000 AS loudness, CAST(l_suppkey % 2 AS INT) AS mode,
 l_tax*5 AS speechiness, (l_orderkey % 101)/100 AS acousticness, l_discount*l_tax*100 AS instrumentalness,
 (l_partkey % 37)/36 AS liveness, (l_suppkey % 53)/52 AS valence, 40 + l_quantity*4 AS tempo,
 CAST(3 + l_linenumber % 3 AS INT) AS time_signature
 FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
tracks AS MATERIALIZED (SELECT base.*, g.raw_label AS track_genre,
 CASE WHEN acousticness >= CAST(0.7 AS DOUBLE) THEN 'acoustic' WHEN speechiness >= CAST(0.33 AS DOUBLE) THEN 'vocal'
      WHEN energy >= CAST(0.8 AS DOUBLE) AND loudness < -20 THEN 'heavy' WHEN energy >= CAST(0.6 AS DOUBLE) THEN 'electronic'
      WHEN danceability >= CAST(0.6 AS DOUBLE) THEN 'dance' ELSE 'alternative' END AS signal_genre
FROM base LEFT JOIN genre_dim g ON base.gid = g.gid)"""
MAPPED = """mapped AS (SELECT t.*, coalesce(x.super_genre, t.track_genre) AS super_genre
 FROM tracks t LEFT JOIN taxonomy x ON t.track_genre = x.raw WHERE t.track_genre IS NOT NULL)"""
PREDICTIONS = """s AS (SELECT track_id, signal_genre AS y_true, acousticness AS s0, CAST(35 AS DOUBLE)/100 AS s1,
 danceability*7/10 AS s2, energy*8/10 AS s3, energy*(0 - loudness)/50 AS s4, speechiness*2 AS s5 FROM tracks),
p AS (SELECT track_id, y_true, s0/(s0+s1+s2+s3+s4+s5) AS p_acoustic, s1/(s0+s1+s2+s3+s4+s5) AS p_alternative,
 s2/(s0+s1+s2+s3+s4+s5) AS p_dance, s3/(s0+s1+s2+s3+s4+s5) AS p_electronic,
 s4/(s0+s1+s2+s3+s4+s5) AS p_heavy, s5/(s0+s1+s2+s3+s4+s5) AS p_vocal FROM s),
m AS (SELECT p.*, greatest(p_acoustic, p_alternative, p_dance, p_electronic, p_heavy, p_vocal) AS top1 FROM p),
predictions AS MATERIALIZED (SELECT m.*, CASE WHEN p_acoustic = top1 THEN 'acoustic' WHEN p_alternative = top1 THEN 'alternative'
 WHEN p_dance = top1 THEN 'dance' WHEN p_electronic = top1 THEN 'electronic'
 WHEN p_heavy = top1 THEN 'heavy' ELSE 'vocal' END AS y_pred FROM m)"""
PLAYLISTS = "playlists(genre, pos, name, \"desc\", query, url) AS ({})".format(values(
    (g, i, *p, S.SEARCH_URL_PREFIX + quote(p[2])) for g, ps in S.PLAYLISTS.items() for i, p in enumerate(ps, 1)))
TAGLINES = f"taglines(genre, tagline) AS ({values(S.TAGLINES.items())})"
CLASSES = f"classes(cls, pos) AS ({values((c, i) for i, c in enumerate(S.CLASSES))})"


def on_tracks(sql: str, *ctes: str) -> str:
    """``sql`` over the tracks view; extra CTEs come after it."""
    return "WITH " + ", ".join([GENRE_DIM, TRACKS, *ctes]) + "\n" + sql


def on_mapped(sql: str, *ctes: str) -> str:
    return on_tracks(sql, TAXONOMY, MAPPED, *ctes)


def on_predictions(sql: str, *ctes: str) -> str:
    return on_tracks(sql, PREDICTIONS, *ctes)


def unpivot(table: str, columns, keep: str = "", name: str = "feature", value: str = "value",
            cast: str = "DOUBLE") -> str:
    """UNION ALL of one SELECT per column."""
    head = f"{keep}, " if keep else ""
    return " UNION ALL ".join(
        f"SELECT {head}'{c}' AS {name}, CAST({c} AS {cast}) AS {value} FROM {table}" for c in columns)


def per_column(table: str, columns, expressions: str) -> str:
    """UNION ALL of one aggregate row per column; ``{c}`` is the column as double."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, " + expressions.replace("{c}", f"CAST({c} AS DOUBLE)") + f" FROM {table}"
        for c in columns)

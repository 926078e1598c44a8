"""DuckDB twins of the registered queries (the correctness oracle).

Each entry is plain SQL over the driver tables. Shared definitions (the track
binding, Silver, features) are prepended as CTEs, written once here and
identical in meaning to the DataFrame definitions.
"""

from __future__ import annotations

from cadence.plans.binding import PREDICTIONS_SQL, TRACKS_SQL
from cadence.sources.schemas import MESSAGE_COLUMNS

_KEY = "track_id"
_ORDER = ["kafka_timestamp", "track_genre"]
_REST = [c for c in MESSAGE_COLUMNS if c != _KEY and c not in _ORDER]
_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in MESSAGE_COLUMNS)
_SILVER_SELECT = ", ".join(
    "CAST(CASE WHEN explicit = 'True' THEN 1 WHEN explicit = 'False' THEN 0 ELSE 0 END AS INTEGER) AS explicit"
    if c == "explicit" else c for c in MESSAGE_COLUMNS)

CTE = {
    "trk": TRACKS_SQL,
    "deduped": f"""
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY {', '.join(_ORDER + _REST)}) AS _rn
  FROM trk WHERE {_NOT_NULL}) WHERE _rn = 1""",
    "silver": f"SELECT {_SILVER_SELECT} FROM deduped WHERE popularity BETWEEN 0 AND 100",
    "feat": """
SELECT s.*,
  CAST(energy AS DOUBLE) / (CAST(danceability AS DOUBLE) + 1e-4) AS energy_danceability_ratio,
  CASE WHEN b.hi - b.lo > 0 THEN (CAST(loudness AS DOUBLE) - b.lo) / (b.hi - b.lo)
       WHEN b.hi - b.lo = 0 THEN 0e0 END AS loudness_normalized,
  CASE WHEN CAST(tempo AS DOUBLE) < 100 THEN 'slow' WHEN CAST(tempo AS DOUBLE) <= 140 THEN 'medium'
       WHEN CAST(tempo AS DOUBLE) > 140 THEN 'fast' END AS tempo_category,
  CAST(energy AS DOUBLE) - CAST(acousticness AS DOUBLE) AS energy_acoustic_contrast,
  (CAST(danceability AS DOUBLE) + CAST(valence AS DOUBLE)) / 2e0 AS dancefloor_score
FROM silver s, (SELECT min(CAST(loudness AS DOUBLE)) AS lo, max(CAST(loudness AS DOUBLE)) AS hi FROM silver) b""",
    "pred": PREDICTIONS_SQL,
}

# Which CTEs each CTE needs (in order).
_DEPS = {"trk": [], "deduped": ["trk"], "silver": ["trk", "deduped"],
         "feat": ["trk", "deduped", "silver"], "pred": []}


def with_ctes(body: str, *names: str) -> str:
    needed: list[str] = []
    for n in names:
        for d in _DEPS[n] + [n]:
            if d not in needed:
                needed.append(d)
    ctes = ",\n".join(f"{n} AS ({CTE[n]})" for n in needed)
    return f"WITH {ctes}\n{body}"

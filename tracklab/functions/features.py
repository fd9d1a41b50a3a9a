"""The 15 -> 42 feature expressions (F1-F15) and other scalar helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklab import schema as S
from tracklab.operators.small import div, half_even


def _x(name: str) -> Column:
    return F.col(name).cast("double")


def _log1p(name: str) -> Column:
    """log(1 + max(x, 0)); null stays null (greatest would skip it)."""
    return F.when(_x(name) > 0, F.log1p(_x(name))).when(_x(name) <= 0, F.lit(0.0))


def _share(name: str, whole: float) -> Column:
    return _x(name) / F.lit(float(whole))


def _flag(condition: Column) -> Column:
    """1.0 / 0.0, and 0.0 when the condition is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("double")


def _square(column: Column) -> Column:
    return column * column


def engineered() -> dict[str, Column]:
    """Name -> expression of the 27 derived features; null in gives null out, but for the flags."""
    not_acoustic = F.lit(1.0) - _x("acousticness")
    safe_energy = _x("energy") + F.lit(1e-6)
    loud = F.abs(_x("loudness"))
    tempo = _share("tempo", 250)
    popularity = _share("popularity", 100)
    return {
        **{f"log1p_{c}": _log1p(c)
           for c in ("speechiness", "acousticness", "instrumentalness", "liveness")},
        "duration_min": _share("duration_ms", 60000),
        "log_duration_ms": _log1p("duration_ms"),
        "abs_loudness": loud,
        "loudness_norm": loud / F.lit(60.0),
        "energy_x_not_acoustic": _x("energy") * not_acoustic,
        "dance_x_energy": _x("danceability") * _x("energy"),
        "valence_x_energy": _x("valence") * _x("energy"),
        "valence_x_dance": _x("valence") * _x("danceability"),
        "speech_x_not_acoustic": _x("speechiness") * not_acoustic,
        "instrumental_x_energy": _x("instrumentalness") * _x("energy"),
        "loudness_per_energy": div(loud, safe_energy),
        "pop_x_dance": popularity * _x("danceability"),
        "acoustic_x_valence": _x("acousticness") * _x("valence"),
        "tempo_sq": _square(tempo),
        "popularity_sq": _square(popularity),
        "energy_sq": _square(_x("energy")),
        "acousticness_sq": _square(_x("acousticness")),
        "instrumentalness_sq": _square(_x("instrumentalness")),
        "tempo_norm": tempo,
        "tempo_slow": _flag(_x("tempo") < 90),
        "tempo_fast": _flag(_x("tempo") > 140),
        "key_x_mode": _x("key") * _x("mode"),
        "liveness_ratio": div(_x("liveness"), safe_energy),
    }


def feature_names() -> list[str]:
    """All 42 output names, originals first."""
    return [*S.FEATURES, *S.ENGINEERED]


def engineer(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns, the 15 inputs as doubles and the 27 derived features."""
    derived = engineered()
    return df.select(
        *keep,
        *[_x(c).alias(c) for c in S.FEATURES],
        *[derived[name].alias(name) for name in S.ENGINEERED],
    )


def track_url(track_id: Column) -> Column:
    return F.concat(F.lit(S.TRACK_URL_PREFIX), track_id)


def search_url(query: Column) -> Column:
    """Search link with percent-encoding: space as %20, slash and tilde kept."""
    encoded = F.url_encode(query)
    for escaped, wanted in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        encoded = F.replace(encoded, F.lit(escaped), F.lit(wanted))
    return F.concat(F.lit(S.SEARCH_URL_PREFIX), encoded)


def percent(probability: Column) -> Column:
    return half_even(probability * 100, 1)


def descending(probabilities: Column) -> Column:
    return F.sort_array(probabilities, asc=False)


def top_gap(probabilities: Column) -> Column:
    """Largest minus second largest of an array."""
    ordered = descending(probabilities)
    return F.get(ordered, F.lit(0)) - F.get(ordered, F.lit(1))


def first_argmax(names: Sequence[str], values: Sequence[Column]) -> Column:
    """Name of the largest value; the earliest name wins ties."""
    top = F.greatest(*values)
    choice = F.lit(names[-1])
    for name, value in reversed(list(zip(names[:-1], values[:-1]))):
        choice = F.when(value == top, F.lit(name)).otherwise(choice)
    return choice

"""Language filter over pluggable detectors."""

from __future__ import annotations

import os
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Language
from ..functions.text import bound, words
from ..schema import first_reason, live

#: Frequent short words of each language, for the native detector.
PROFILES = {
    "de": "der die das und ist nicht ein eine zu den mit sich des auf für im dem von auch als".split(),
    "en": "the of and to in is that it was for on with as at by this are be from or".split(),
    "es": "de la que el en y los se del las un por con una para es al lo como su".split(),
    "fr": "de la le et les des en un une du dans que est pour qui sur par au avec pas".split(),
}
#: External detectors read so many characters.
SAMPLE_CHARS = 4000


def profile(text: Column) -> Column:
    """struct(lang, conf): the language with most of its short words in the text, and its share of all such hits. Native."""
    names = sorted(PROFILES)

    def hits(found: Column, name: str) -> Column:
        return F.size(F.filter(found, lambda w: w.isin(PROFILES[name])))

    def judge(h: Column) -> Column:
        best, total = F.array_max(h), F.aggregate(h, F.lit(0), lambda a, x: a + x)
        lang = F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position(h, best).cast("int"))
        return F.when(best > 0, F.struct(lang.alias("lang"), (best / total).alias("conf")))

    return bound(bound(words(F.lower(text)), lambda found: F.array(*[hits(found, n) for n in names])), judge)


def _external(call: Callable[[], Callable[[str], tuple[str | None, float | None]]]) -> Callable[[Column], Column]:
    """A detector in Python: made once for each worker; text it cannot judge gives nulls."""

    def build(text: Column) -> Column:
        @F.pandas_udf("lang string, conf double")
        def run(batches):
            try:
                detect = call()
            except ImportError:
                detect = None
            for texts in batches:
                out = []
                for t in texts:
                    try:
                        out.append(detect(t[:SAMPLE_CHARS].replace("\n", " ").strip()) if detect and isinstance(t, str) else (None, None))
                    except Exception:  # noqa: BLE001  a detector that fails on a text leaves it unknown
                        out.append((None, None))
                yield pd.DataFrame(out, columns=["lang", "conf"])

        run.func.__annotations__ = {}
        return run(text)

    return build


def _fast_langdetect():
    from fast_langdetect import detect

    def one(text: str) -> tuple[str | None, float | None]:
        got = detect(text)
        got = got[0] if isinstance(got, list) and got else got
        if isinstance(got, dict):
            score = got.get("score", got.get("prob"))
            return got.get("lang"), None if score is None else float(score)
        return (got, 1.0) if isinstance(got, str) else (None, None)

    return one


def _fasttext():
    import fasttext

    model = fasttext.load_model(os.environ["FASTTEXT_LID_MODEL"])

    def one(text: str) -> tuple[str | None, float | None]:
        labels, scores = model.predict(text, k=1)
        return (labels[0].removeprefix("__label__"), float(scores[0])) if labels else (None, None)

    return one


def _installed(name: str) -> bool:
    import importlib.util

    return importlib.util.find_spec(name) is not None


def detected(df: DataFrame, detector: str) -> Column | None:
    """struct(lang, conf) by the named detector; the native profile stands in for a library that is not installed."""
    text = F.col("text")
    if detector == "column":
        return F.struct(F.col("lang").alias("lang"), F.coalesce(F.col("lang_conf"), F.lit(1.0)).alias("conf"))
    if detector == "fast_langdetect" and _installed("fast_langdetect"):
        return _external(_fast_langdetect)(text)
    if detector == "fasttext" and _installed("fasttext") and os.environ.get("FASTTEXT_LID_MODEL"):
        return _external(_fasttext)(text)
    if detector in ("profile", "fast_langdetect", "fasttext"):
        return profile(text)
    return None


def language_filter(df: DataFrame, cfg: Language) -> DataFrame:
    """Add lang, lang_conf and the first of six drop codes."""
    if not cfg.enabled:
        return df
    found = detected(df, cfg.detector)
    out = df.withColumn("_d", F.lit(None).cast("struct<lang:string,conf:double>") if found is None else found)
    n, lang, conf = F.length("text"), F.col("_d.lang"), F.col("_d.conf")
    known = lang.isNotNull() & (lang != "") & conf.isNotNull()
    rules = [
        ("no_text", F.coalesce(F.col("text"), F.lit("")) == "", None),
        ("too_short", n < cfg.min_chars, F.concat(F.lit("chars="), n.cast("string"))),
        ("bad_detector", F.lit(found is None), cfg.detector),
        ("lang_unknown", ~known, None),
        ("low_conf", conf < cfg.min_confidence, F.format_string("%s=%.3f", lang, conf)),
    ]
    if cfg.target_langs:
        rules.append(("lang_mismatch", ~lang.isin(*cfg.target_langs), lang))
    judged = live() & (F.coalesce(F.col("text"), F.lit("")) != "") & (n >= cfg.min_chars)
    out = out.withColumn("drop", first_reason("language", rules).alias("drop"))
    return out.withColumn("lang", F.when(judged | F.col("drop").isNull(), lang).otherwise(F.col("lang"))).withColumn("lang_conf", F.when(judged | F.col("drop").isNull(), conf).otherwise(F.col("lang_conf"))).drop("_d")


def language_histogram(df: DataFrame) -> DataFrame:
    """Documents that passed the language stage, by language (later drops still count)."""
    passed = live() | ~F.col("drop.stage").isin("fetch", "extract", "language")
    return df.where(passed & F.col("lang").isNotNull()).groupBy("lang").agg(F.count("*").alias("n"))

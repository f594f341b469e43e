"""Operators for preparing training data. Nothing else in the package imports this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import audio, bpe, decontam, html, linededup, lm, pii, pq, quality, resample, simhash, treebpe, urlfilter

    return {
        "op1_simhash": simhash.op1_simhash,
        "op2_lm_score": lm.op2_lm_score,
        "op3_audio": audio.op3_audio,
        "op4_bpe": bpe.op4_bpe,
        "op5_html": html.op5_html,
        "op6_pii": pii.op6_pii,
        "op7_quality": quality.op7_quality,
        "op8_line_dedup": linededup.op8_line_dedup,
        "op9_decontaminate": decontam.op9_decontaminate,
        "op10_url_filter": urlfilter.op10_url_filter,
        "op11_byte_bpe": treebpe.op11_byte_bpe,
        "op12_vector_codes": pq.op12_vector_codes,
        "op13_resample": resample.op13_resample,
    }


def oracle_sql() -> dict[str, str]:
    from . import decontam, linededup, pq, resample, urlfilter

    return {"op8_line_dedup": linededup.ORACLE_SQL, "op9_decontaminate": decontam.ORACLE_SQL, "op10_url_filter": urlfilter.ORACLE_SQL, "op12_vector_codes": pq.ORACLE_SQL, "op13_resample": resample.ORACLE_SQL}

"""Registered queries of the numbered operators and the DuckDB SQL of those that SQL expresses."""

from __future__ import annotations

from . import (
    ann,
    decontaminate,
    hard_negatives,
    html_extract,
    license_scan,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    quality_rules,
    url_filter,
    warc,
    whitening,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_near_dedup": near_dedup.op2_near_dedup,
    "op3_url_filter": url_filter.op3_url_filter,
    "op4_quality_classifier": quality.op4_quality_classifier,
    "op5_warc": warc.op5_warc,
    "op6_license_scan": license_scan.op6_license_scan,
    "op7_html_extraction": html_extract.op7_html_extraction,
    "op8_nearest_neighbours": ann.op8_nearest_neighbours,
    "op9_source_mixing": mixing.op9_source_mixing,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_quality_rules": quality_rules.op12_quality_rules,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
SQL = {
    "op1_line_dedup": line_dedup.SQL,
    "op3_url_filter": url_filter.SQL,
    "op5_warc": warc.SQL,
    "op6_license_scan": license_scan.SQL,
    "op9_source_mixing": mixing.SQL,
    "op10_decontamination": decontaminate.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}

"""The registered queries of the corpus operators and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexisift.llm.additive_ann import OP9_SQL, op9_additive_ann
from lexisift.llm.byte_bpe import op10_byte_bpe
from lexisift.llm.filter_audit import OP12_SQL, op12_filter_audit
from lexisift.llm.html_density import op4_html_density
from lexisift.llm.importance_resampling import OP11_SQL, op11_importance_resampling
from lexisift.llm.jaccard_join import OP7_SQL, op7_jaccard_join
from lexisift.llm.jpeg_media import op5_jpeg_media
from lexisift.llm.langid_crf import op8_langid_crf
from lexisift.llm.packing import op6_retrieval_packing
from lexisift.llm.piecewise_hash import op13_piecewise_hash
from lexisift.llm.secret_scan import OP3_SQL, op3_secret_scan
from lexisift.llm.token_counts import op1_token_counts
from lexisift.llm.warc import OP2_SQL, op2_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_warc": op2_warc,
    "op3_secret_scan": op3_secret_scan,
    "op4_html_density": op4_html_density,
    "op5_jpeg_media": op5_jpeg_media,
    "op6_retrieval_packing": op6_retrieval_packing,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_langid_crf": op8_langid_crf,
    "op9_additive_ann": op9_additive_ann,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_filter_audit": op12_filter_audit,
    "op13_piecewise_hash": op13_piecewise_hash,
}

ORACLE: dict[str, str] = {
    "op2_warc": OP2_SQL,
    "op3_secret_scan": OP3_SQL,
    "op7_jaccard_join": OP7_SQL,
    "op9_additive_ann": OP9_SQL,
    "op11_importance_resampling": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
}

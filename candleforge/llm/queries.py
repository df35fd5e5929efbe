"""The queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from candleforge.llm.chat import OP5_SQL, op5_chat_formatting
from candleforge.llm.decontam import OP8_SQL, op8_benchmark_decontamination
from candleforge.llm.embeddings import OP1_SQL, op1_embedding_dedup
from candleforge.llm.jaccard import OP2_SQL, op2_ngram_jaccard
from candleforge.llm.langid import op9_language_id
from candleforge.llm.licenses import op10_license_scan
from candleforge.llm.lines import OP6_SQL, op6_line_dedup
from candleforge.llm.packing import op7_packing
from candleforge.llm.urls import op4_url_filter
from candleforge.llm.warc import OP3_SQL, op3_warc

QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_warc": op3_warc,
    "op4_url_filter": op4_url_filter,
    "op5_chat_formatting": op5_chat_formatting,
    "op6_line_dedup": op6_line_dedup,
    "op7_packing": op7_packing,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_language_id": op9_language_id,
    "op10_license_scan": op10_license_scan,
}
SQL = {
    "op1_embedding_dedup": OP1_SQL,
    "op2_ngram_jaccard": OP2_SQL,
    "op3_warc": OP3_SQL,
    "op5_chat_formatting": OP5_SQL,
    "op6_line_dedup": OP6_SQL,
    "op8_benchmark_decontamination": OP8_SQL,
}

"""The subpackage's queries and their SQL."""

from __future__ import annotations

from . import chat, clusters, decontaminate, html_text, mixing, near_dedup, quality, ranked, substrings, topk, toxicity, url_filter, warc

QUERIES = {
    "op1_html_text": html_text.op1_html_text,
    "op2_topk": topk.op2_topk,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_warc": warc.op4_warc,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_mix_sources": mixing.op6_mix_sources,
    "op7_quality": quality.op7_quality,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_chat_format": chat.op9_chat_format,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_toxicity": toxicity.op11_toxicity,
    "op12_clusters": clusters.op12_clusters,
    "op13_ranked": ranked.op13_ranked,
}

ORACLES = {
    "op1_html_text": html_text.OP1_SQL,
    "op2_topk": topk.OP2_SQL,
    "op4_warc": warc.OP4_SQL,
    "op5_near_dedup": near_dedup.OP5_SQL,
    "op6_mix_sources": mixing.OP6_SQL,
    "op9_chat_format": chat.OP9_SQL,
    "op10_url_filter": url_filter.OP10_SQL,
    "op12_clusters": clusters.OP12_SQL,
    "op13_ranked": ranked.OP13_SQL,
}

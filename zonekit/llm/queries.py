"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from zonekit.llm.exact_dedup import op4_exact_dedup
from zonekit.llm.jaccard_join import op5_jaccard_join
from zonekit.llm.language_id import op3_language_fusion
from zonekit.llm.mixing import op7_weighted_mix
from zonekit.llm.packing import op9_hilbert_packing
from zonekit.llm.periodic_runs import op13_periodic_runs
from zonekit.llm.pii import op8_pii_sanitisation
from zonekit.llm.prefix_trie import op12_prefix_trie
from zonekit.llm.quality import op10_quality_rules
from zonekit.llm.quote_links import op2_quote_linking
from zonekit.llm.sharding import op11_shuffled_shards
from zonekit.llm.substring_dedup import op1_sentence_span_dedup
from zonekit.llm.warc import op6_warc_normaliser

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentence_span_dedup": op1_sentence_span_dedup,
    "op2_quote_linking": op2_quote_linking,
    "op3_language_fusion": op3_language_fusion,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_warc_normaliser": op6_warc_normaliser,
    "op7_weighted_mix": op7_weighted_mix,
    "op8_pii_sanitisation": op8_pii_sanitisation,
    "op9_hilbert_packing": op9_hilbert_packing,
    "op10_quality_rules": op10_quality_rules,
    "op11_shuffled_shards": op11_shuffled_shards,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}

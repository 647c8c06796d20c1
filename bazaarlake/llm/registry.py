"""The queries of the operators, and the SQL of those that SQL can express."""

from bazaarlake.llm.conversations import op12_auction_repair
from bazaarlake.llm.decontaminate import op7_qgram_lemma
from bazaarlake.llm.html_extract import OP6_SQL, op6_tree_model
from bazaarlake.llm.importance import op13_importance_sort
from bazaarlake.llm.line_dedup import op2_line_prefix_join
from bazaarlake.llm.mixing import OP10_SQL, op10_pareto_mixing
from bazaarlake.llm.neural_lm import op11_log_bilinear
from bazaarlake.llm.ngram_join import op5_lsh_forest
from bazaarlake.llm.quality_rules import OP9_SQL, op9_rule_ledger
from bazaarlake.llm.sharding import op3_virtual_slots
from bazaarlake.llm.token_counts import op8_length_histogram
from bazaarlake.llm.url_filter import OP1_SQL, op1_host_trust
from bazaarlake.llm.warc import OP4_SQL, op4_gzip_normaliser

QUERIES = {
    q.__name__: q
    for q in (
        op1_host_trust,
        op2_line_prefix_join,
        op3_virtual_slots,
        op4_gzip_normaliser,
        op5_lsh_forest,
        op6_tree_model,
        op7_qgram_lemma,
        op8_length_histogram,
        op9_rule_ledger,
        op10_pareto_mixing,
        op11_log_bilinear,
        op12_auction_repair,
        op13_importance_sort,
    )
}

SQL = {
    "op1_host_trust": OP1_SQL,
    "op4_gzip_normaliser": OP4_SQL,
    "op6_tree_model": OP6_SQL,
    "op9_rule_ledger": OP9_SQL,
    "op10_pareto_mixing": OP10_SQL,
}

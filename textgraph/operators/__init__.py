from textgraph.operators.cells import cell_product, dedupe_cells, fill_cells, normalize_rows
from textgraph.operators.counts import doc_freq, term_freq, word_count
from textgraph.operators.graph import (
    attach_links,
    dedupe_adjacency,
    links_of,
    node_count,
    page_table,
    pagerank_step,
    prepare_graph,
    rank_contributions,
)
from textgraph.operators.order import order_report
from textgraph.operators.terms import drop_terms, keep_terms
from textgraph.operators.weights import l2_normalize, relevance, tf_idf, top_k

__all__ = [
    "attach_links",
    "cell_product",
    "dedupe_adjacency",
    "dedupe_cells",
    "doc_freq",
    "drop_terms",
    "fill_cells",
    "keep_terms",
    "l2_normalize",
    "links_of",
    "node_count",
    "normalize_rows",
    "order_report",
    "page_table",
    "pagerank_step",
    "prepare_graph",
    "rank_contributions",
    "relevance",
    "term_freq",
    "tf_idf",
    "top_k",
    "word_count",
]

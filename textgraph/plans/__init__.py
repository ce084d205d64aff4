from textgraph.plans.graph import pagerank, pagerank_links
from textgraph.plans.recommend import factored_product, recommend, sparse_matmul
from textgraph.plans.search import score_documents, search_documents
from textgraph.plans.words import common_words, count_words

__all__ = [
    "common_words",
    "count_words",
    "factored_product",
    "pagerank",
    "pagerank_links",
    "recommend",
    "score_documents",
    "search_documents",
    "sparse_matmul",
]

"""Driver queries: each operator over the whole test tables, with equal SQL."""

from textgraph_checks import files, graph, matrix, search, words

GROUPS = (words, search, graph, matrix, files)
QUERIES = {name: query for group in GROUPS for name, query in group.QUERIES.items()}
SQL = {name: sql for group in GROUPS for name, sql in group.SQL.items()}

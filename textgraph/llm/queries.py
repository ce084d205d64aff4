"""The queries of this package, each over its whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from textgraph.llm.bpe import op2_bpe
from textgraph.llm.chat import op7_chat
from textgraph.llm.fingerprints import op4_fingerprints
from textgraph.llm.lm import op5_lm
from textgraph.llm.merkle import op13_merkle
from textgraph.llm.mixing import op8_mixing
from textgraph.llm import jaccard, merkle, phrases, search
from textgraph.llm.jaccard import op1_jaccard
from textgraph.llm.packing import op12_packing
from textgraph.llm.phrases import op11_phrases
from textgraph.llm.search import op3_top_k
from textgraph.llm.quality import op6_quality
from textgraph.llm.secrets import op10_secrets
from textgraph.llm.toxicity import op9_toxicity

QUERIES = {q.__name__: q for q in (op1_jaccard, op2_bpe, op3_top_k, op4_fingerprints, op5_lm, op6_quality, op7_chat, op8_mixing, op9_toxicity, op10_secrets, op11_phrases, op12_packing, op13_merkle)}

SQL = {
    "op1_jaccard": jaccard.SQL,
    "op3_top_k": search.SQL,
    "op11_phrases": phrases.SQL,
    "op13_merkle": merkle.SQL,
    "op7_chat": r"""
        WITH given AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]', '', ''
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]', '', ''
        ), sized AS (
            SELECT *, length(regexp_replace(role, '([\\<\[])', '\\\1', 'g')) + length(regexp_replace(text, '([\\<\[])', '\\\1', 'g'))
                + CASE WHEN role = 'assistant' THEN 8 ELSE 19 END AS chars FROM given
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
            CAST(sum(chars) AS BIGINT) AS formatted_chars, false AS rewrites
        FROM sized GROUP BY conv_id""",
}

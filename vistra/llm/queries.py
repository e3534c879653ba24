"""Registered queries of the numbered operators, and their SQL where it can say them."""

from __future__ import annotations

from vistra.llm.chat import op10_chat_format
from vistra.llm.decontamination import op4_decontamination
from vistra.llm.html_text import op5_html_text
from vistra.llm.jaccard import op7_jaccard_join
from vistra.llm.language import op6_language_id
from vistra.llm.latent_words import op12_latent_word_scores
from vistra.llm.lexical_search import op11_lexical_search
from vistra.llm.packing import op3_histogram_packing
from vistra.llm.pii import op1_bootstrapped_pii
from vistra.llm.quality import op8_quality_rules
from vistra.llm.token_counts import op9_token_counts
from vistra.llm.token_files import op2_elias_fano_token_files
from vistra.llm.vector_codes import op13_vector_codes

QUERIES = {
    "op1_bootstrapped_pii": op1_bootstrapped_pii,
    "op2_elias_fano_token_files": op2_elias_fano_token_files,
    "op3_histogram_packing": op3_histogram_packing,
    "op4_decontamination": op4_decontamination,
    "op5_html_text": op5_html_text,
    "op6_language_id": op6_language_id,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_counts": op9_token_counts,
    "op10_chat_format": op10_chat_format,
    "op11_lexical_search": op11_lexical_search,
    "op12_latent_word_scores": op12_latent_word_scores,
    "op13_vector_codes": op13_vector_codes,
}

_WORDS = "[x FOR x IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+') IF x <> '']"



def _codes_sql(rounds: int = 4) -> str:
    """Rounds of assignment and floored means, one after another; entries are whole codebooks by part."""
    steps = ["""kept AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) AS nr, [floor(1024 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)""",
        """parts AS (SELECT nr, p, v[p * len(v) // 4 + 1 : (p + 1) * len(v) // 4] AS x FROM kept, range(4) r(p))""",
        """book0 AS (SELECT p, nr - 1 AS entry, x FROM parts WHERE nr <= 256)"""]  # fmt: skip
    far = "list_sum([(a.x[i] - b.x[i]) * (a.x[i] - b.x[i]) FOR i IN range(1, len(a.x) + 1)])"
    for r in range(rounds + 1):
        steps.append(
            f"far{r} AS (SELECT nr, p, min(struct_pack(d := {far}, e := b.entry)) AS best FROM parts a JOIN book{r} b USING (p) GROUP BY nr, p)"
        )
        if r < rounds:
            steps.append(f"""book{r + 1} AS (
  SELECT b.p, b.entry, coalesce(m.x, b.x) AS x FROM book{r} b LEFT JOIN (
    SELECT p, entry, list(c ORDER BY i) AS x FROM (
      SELECT p, f.best.e AS entry, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS c FROM far{r} f JOIN parts USING (nr, p), range(1, 65536) s(i)
      WHERE i <= len(x) GROUP BY ALL) GROUP BY ALL) m USING (p, entry))""")
    steps.append(f"""rows AS (
  SELECT nr, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM far{rounds} GROUP BY nr)""")
    steps.append(f"digest AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, entry)) AS h FROM book{rounds})")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM kept JOIN rows USING (nr), digest"""


ORACLE: dict[str, str] = {
    "op7_jaccard_join": f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS s FROM w),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
lowest AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON d.doc_id = lowest.x""",
    "op10_chat_format": """WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(role) + length(text)
    + 2 * length(role || text) - length(replace(role || text, '<', '')) - length(replace(role || text, '\\', '')) AS chars FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars + length('<|turn|><|say|><|end|>') + 1)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op11_lexical_search": """WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM documents),
bag AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM bag GROUP BY doc_id),
totals AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM sizes),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
wanted AS (SELECT item_id, t, count(*) AS times FROM q GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM bag WHERE t IN (SELECT t FROM wanted) GROUP BY t),
w AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM df, totals),
norm AS (SELECT doc_id, 75 + (25 * n * nd) // l AS m FROM sizes, totals),
scored AS (
  SELECT item_id, doc_id, sum(times * w.w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM wanted JOIN w USING (t) JOIN bag USING (t) JOIN norm USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20""",
    "op13_vector_codes": _codes_sql(),
}

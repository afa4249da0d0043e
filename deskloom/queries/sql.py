"""Text helpers that write the oracle SQL from the same rule sets the Spark side gets."""

from __future__ import annotations

from deskloom.presets import cases, rules, taxonomy

BLANK = r"[\s\v\x1c-\x1f\x{85}\p{Z}]"
NON_BLANK = r"[^\s\v\x1c-\x1f\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]+"


def lit(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def values(name: str, columns: str, rows) -> str:
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES {body})"


def any_match(text: str, patterns) -> str:
    return "(" + " OR ".join(f"regexp_matches({text}, {lit('(?i)' + p)})" for p in patterns) + ")"


def hits(text: str, patterns) -> str:
    return "(" + " + ".join(f"regexp_matches({text}, {lit('(?i)' + p)})::INT" for p in patterns) + ")"


def any_phrase(lower: str, phrases) -> str:
    return "(" + " OR ".join(f"contains({lower}, {lit(p)})" for p in phrases) + ")"


def phrase_hits(lower: str, phrases) -> str:
    return "(" + " + ".join(f"contains({lower}, {lit(p)})::INT" for p in phrases) + ")"


def best_class(score_list: str, classes, default: str) -> str:
    """First class with the largest score of a SQL list; the default if all are 0."""
    names = "[" + ", ".join(lit(c) for c in classes) + "]"
    return (f"CASE WHEN list_max({score_list}) > 0 "
            f"THEN {names}[list_position({score_list}, list_max({score_list}))] ELSE {lit(default)} END")


def hit_list(text: str, ruleset) -> str:
    return "[" + ", ".join(hits(text, p) for p in ruleset.values()) + "]"


def phrase_list(lower: str, keywords) -> str:
    return "[" + ", ".join(phrase_hits(lower, p) for p in keywords.values()) + "]"


def words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), '{WORD}')"


def strip(text: str) -> str:
    return rf"regexp_replace({text}, '^{BLANK}+|{BLANK}+\z', '', 'g')"


def key(text: str) -> str:
    return strip(f"lower({text})")


def clean(text: str) -> str:
    no_urls = f"regexp_replace({text}, 'https?://{NON_BLANK}+', '[URL]', 'g')"
    no_handles = rf"regexp_replace({no_urls}, '@\p{{Nd}}{{4,}}', '@user', 'g')"
    return strip(f"regexp_replace({no_handles}, '{BLANK}+', ' ', 'g')")


def ascii_words(text: str) -> str:
    r"""Accented Latin letters to a plain letter, so that the ASCII ``\b`` of the oracle sees them as letters."""
    return rf"regexp_replace({text}, '[\x{{AA}}\x{{B5}}\x{{BA}}\x{{C0}}-\x{{D6}}\x{{D8}}-\x{{F6}}\x{{F8}}-\x{{24F}}]', 'x', 'g')"


def pick(id_col: str, salt: str, choices) -> str:
    return f"(('0x' || substr(md5('{salt}' || {id_col}::VARCHAR), 1, 8))::BIGINT % {choices})"


def lookup(column: str, table: dict, default) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in table.items())
    return f"CASE {column} {whens} ELSE {lit(default)} END"


def escalation_label(text: str, ruleset=rules.LABEL_ESCALATION_RULES) -> str:
    """The first matching escalation reason, or NULL."""
    whens = " ".join(f"WHEN {any_match(f'lower({text})', p)} THEN {lit(r)}" for r, p in ruleset.items())
    return f"CASE {whens} END"


def difficulty(text: str, escalated: str) -> str:
    return (f"CASE WHEN {any_match(text, rules.HARD_CASE_PATTERNS)} THEN 'HARD' "
            f"WHEN {escalated} THEN 'MEDIUM' ELSE 'EASY' END")


def policy_reason(text: str, confidence: str, past: str | None = None) -> str:
    whens = " ".join(f"WHEN {any_match(text, p)} THEN {lit(r)}" for r, _, _, p in rules.POLICY_RULES)
    low = f"WHEN {confidence} < 0.35 THEN 'LOW_CONFIDENCE_AMBIGUITY'"
    return f"CASE {whens} {low} {past or ''} ELSE 'STANDARD_TROUBLESHOOTING' END"


def rubric(query: str, reply: str) -> dict[str, str]:
    """The four rubric scores as SQL expressions over lower-cased columns."""
    robotic = any_phrase(reply, rules.ROBOTIC_PHRASES)

    def ladder(top, middle, middle_score, floor):
        return (f"CASE WHEN {robotic} THEN 2 WHEN {any_phrase(reply, top)} THEN 5 "
                f"WHEN {any_phrase(reply, middle)} THEN {middle_score} ELSE {floor} END")

    return {
        "groundedness": ladder(rules.GROUNDED_PHRASES, rules.GENERIC_ADVICE_WORDS, 3, 2),
        "brand_voice": ladder(rules.WARM_PHRASES, rules.POLITE_PHRASES, 4, 3),
        "actionability": ladder(rules.ACTION_PHRASES, rules.WEAK_ACTION_PHRASES, 3, 2),
        "safety": (f"CASE WHEN {any_phrase(reply, rules.UNSAFE_PHRASES)} THEN 1 "
                   f"WHEN {any_phrase(query, rules.HAZARD_WORDS)} THEN "
                   f"(CASE WHEN {any_phrase(reply, rules.HAZARD_WARNINGS)} THEN 5 ELSE 2 END) "
                   f"WHEN contains({reply}, 'as an ai') THEN 4 ELSE 5 END"),
    }


# Raw messages from the conversation turns.
MESSAGES = """messages AS (
  SELECT CAST(conv_id * 1000 + turn AS VARCHAR) AS tweet_id, role AS author_id, role <> 'assistant' AS inbound,
         text, CASE WHEN turn > 0 THEN CAST(conv_id * 1000 + turn - 1 AS VARCHAR) ELSE '' END
           AS in_response_to_tweet_id, conv_id * 1000 + turn AS seq
  FROM conversations)"""

# Generated support texts, one per document id.
_TEMPLATES = [(c, i, t, a, h, r) for c, rows in cases.TEMPLATES.items() for i, (t, a, h, r) in enumerate(rows)]
TEMPLATE_TABLES = ",\n".join([
    values("classes", "ci, cls, n_templates", [(i, c, len(r)) for i, (c, r) in enumerate(cases.TEMPLATES.items())]),
    values("templates", "cls, ti, customer, agent, auto_handle, reason", _TEMPLATES),
    values("devices", "di, device", list(enumerate(cases.DEVICES))),
    values("os_versions", "oi, os_ver", list(enumerate(cases.OS_VERSIONS))),
])


def generated(source: str, id_col: str) -> str:
    """CTE body: one generated corpus row per id of a table."""
    def fill(c):
        return f"replace(replace({c}, '{{device}}', device), '{{os_ver}}', os_ver)"
    return f"""SELECT s.{id_col} AS gid, '{taxonomy.BRAND_HANDLE} ' || {fill('customer')} AS customer_text, c.cls AS intent,
    {fill('agent')} AS agent_text, auto_handle, reason AS escalation_reason
  FROM {source} s JOIN classes c ON c.ci = {pick('s.' + id_col, 'class', len(cases.TEMPLATES))}
  JOIN templates t ON t.cls = c.cls AND t.ti = {pick('s.' + id_col, 'template', 'c.n_templates')}
  JOIN devices ON di = {pick('s.' + id_col, 'device', len(cases.DEVICES))}
  JOIN os_versions ON oi = {pick('s.' + id_col, 'os', len(cases.OS_VERSIONS))}"""


# Support corpus: a generated message followed by the whole document text.
SUPPORT = f"""{TEMPLATE_TABLES},
generated AS ({generated('documents', 'doc_id')}),
support AS (
  SELECT printf('synth_%05d', doc_id) AS id, g.customer_text || ' ' || d.text AS customer_text, intent, agent_text,
         auto_handle, escalation_reason, source, doc_id AS seq, lang
  FROM documents d JOIN generated g ON g.gid = d.doc_id)"""

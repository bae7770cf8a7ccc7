"""The expressions of functions.text in SQL, for the reference SQL of the queries."""

from curaspark.functions.text import ASCII, BLANK, BLANKS, DASHES, FULL_WIDTH


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trimmed(c: str) -> str:
    return f"trim({c}, {_q(BLANKS)})"


def missing(c: str) -> str:
    return f"coalesce(lower({trimmed(c)}) IN ('', 'none', 'unclassified'), true)"


def rank_key(c: str) -> str:
    t = trimmed(c)
    return f"CASE WHEN NOT {missing(c)} THEN upper(substr({t}, 1, 1)) || lower(substr({t}, 2)) END"


def narrow(c: str) -> str:
    return f"regexp_replace(translate({c}, {_q(FULL_WIDTH + DASHES)}, {_q(ASCII + '-' * len(DASHES))}), '{BLANK}', '', 'g')"


def node_id(c: str) -> str:
    return f"TRY_CAST(regexp_extract({narrow(c)}, '^(?:[A-Za-z]+[:_]?)?\\+?0*(\\d+)(?:\\.0*)?$', 1) AS BIGINT)"

"""Secret scan with DataFrame functions only: patterns plus sliding-window entropy.

Three base kinds come from patterns. The fourth, ``entropy``, comes from runs of at
least ``window`` characters of ``[A-Za-z0-9+/_=-]``. A run has a character class (hex,
one letter case with digits, both cases with digits; others can't be told from prose
and are left out) with its own threshold. A window slides over the run; its Shannon
entropy is kept up to date from the counts of the character that enters and the one
that leaves, and the span goes from the first window at or over the threshold to the
last. Base spans always stay and are cut out of the runs, and so are the stretches that
the allow list names: UUIDs, dates, and whole tokens that say they are examples or
placeholders. What is left on either side counts as a run of its own, so a secret beside
such a stretch is still found. What is left of words joined by hyphens is dropped.

Positions are code points, ends exclusive. They follow from splitting the text at the
matches: a match starts after all pieces and matches before it.

A longer text is first cut into pieces of about ``PIECE`` characters, at places that no
match and no run can hold: after a character that none takes, between a blank and what
follows if no colon or equals sign is beside it, and after a colon that can't follow a
key word. So the work for a text grows in step with its length and its matches; only
within a piece is it quadratic in the matches, which a piece has few of.

Cases: null and empty texts have no span and the digest of the empty string; very long
texts are whole; repeated rows give repeated results; ties of spans go by kind; an empty
table gives an empty result; all other columns stay, whatever their names (``report``
returns the id and its own).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracelake.llm import common

WORDS = ("password", "passwd", "secret", "token", "api_?key")
#: Entropy thresholds in bits by character class, for a window of 20 characters.
WINDOW = 20
THRESHOLDS = {"hex": 2.95, "one_case": 3.45, "both_cases": 3.75}
#: Stretches of a run that aren't secrets: UUIDs and dates.
STRETCHES = "[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}|[0-9]{4}-[0-9]{2}-[0-9]{2}"
#: Tokens (letters and digits) that aren't, whole, where they hold this.
TOKEN = "[A-Za-z0-9]+"
EXAMPLES = "[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[Pp][Ll][Aa][Cc][Ee][Hh][Oo][Ll][Dd][Ee][Rr]|[Xx]{6,}"
#: Whole runs that aren't: words joined by hyphens, with a short number.
ALLOW = (r"^[A-Za-z]+([-_/][A-Za-z]+)+([-_/][0-9]{1,4})?/?$",)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
KINDS = ("assign", "access", "hex", "entropy")

SPAN = "struct<start:int,rank:int,stop:int,kind:string>"


def either_case(word: str) -> str:
    """A pattern for ASCII letters in either case (a case-insensitive flag would also take other letters)."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = "(" + "|".join(map(either_case, WORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
RUN = "[A-Za-z0-9+/_=-]"
#: Characters of a piece, about, and what ends one.
PIECE = 4096
CUT = r"""[^A-Za-z0-9+/_.=\x20:"'-]|(?<=[^:=\x20]\x20)(?=[^:=\x20])|(?<=[^dDtTnNyY"'\x20:=]:)"""


def _spans(kind: str, hits: str, gaps: str, keep: str, at: str = "0") -> str:
    """SQL for the spans of the matches ``hits`` between ``gaps`` of a text that begins ``at``; ``keep`` is a condition on match number i."""
    start = f"acc.at + length({gaps}[i])"
    span = f"named_struct('start', {start}, 'rank', {KINDS.index(kind)}, 'stop', {start} + length({hits}[i]), 'kind', '{kind}')"
    return f"""
        if(size({hits}) = 0, cast(array() as array<{SPAN}>), aggregate(
            sequence(0, size({hits}) - 1),
            named_struct('at', {at}, 'out', cast(array() as array<{SPAN}>)),
            (acc, i) -> named_struct('at', {start} + length({hits}[i]), 'out', if({keep}, concat(acc.out, array({span})), acc.out)),
            acc -> acc.out))"""


def _class(run: str) -> str:
    """SQL for the threshold of a run's character class, null where no class applies."""
    cases = f"{run} rlike '[0-9]' and {run} rlike"
    return f"""case when {run} rlike '^([0-9a-f]+|[0-9A-F]+)$' then if({cases} '[A-Fa-f]', {THRESHOLDS['hex']}D, null)
        when {cases} '[A-Z]' and {run} rlike '[a-z]' then {THRESHOLDS['both_cases']}D
        when {cases} '[A-Za-z]' then {THRESHOLDS['one_case']}D end"""


def _slide(run: str, least: str, window: int) -> str:
    """SQL: struct (first, last) of the windows in ``run`` whose entropy reaches ``least``, by incremental counts."""
    table = ", ".join(["0D"] + [f"{n}D * log2({n}D)" for n in range(1, window + 2)])
    index = f"transform(split({run}, ''), c -> instr('{ALPHABET}', c))"
    # s is the sum of n*log2(n) over the window's counts; the entropy is log2(window) - s/window
    enter = "acc.s + f[acc.n[ix[i] - 1] + 1] - f[acc.n[ix[i] - 1]]"
    leave = f"acc.n[ix[i - {window}] - 1] + if(ix[i - {window}] = ix[i], 1, 0)"
    body = f"if(i < {window}, {enter}, {enter} + f[{leave} - 1] - f[{leave}])"
    counts = f"transform(acc.n, (n, k) -> n + if(k = ix[i] - 1, 1, 0) - if(i >= {window}, if(k = ix[i - {window}] - 1, 1, 0), 0))"
    passes = f"i >= {window - 1} and log2({window}D) - ({body}) / {window}D >= {least}"
    step = f"""named_struct('n', {counts}, 's', {body},
        'first', if(acc.first is null and {passes}, i - {window - 1}, acc.first), 'last', if({passes}, i - {window - 1}, acc.last))"""
    return f"""transform(array(named_struct('ix', {index}, 'f', array({table}))), p -> aggregate(
        sequence(0, length({run}) - 1),
        named_struct('n', array_repeat(0, {len(ALPHABET)}), 's', 0D, 'first', cast(null as int), 'last', cast(null as int)),
        (acc, i) -> {step.replace('ix[', 'p.ix[').replace(' f[', ' p.f[')},
        acc -> named_struct('first', acc.first, 'last', acc.last)))[0]"""


def _allowed(run: str, at: str, stretches: str, examples: str) -> str:
    """SQL: spans of the allow list's stretches and tokens in ``run``, which begins ``at``."""

    def of(pattern: str, keep: str) -> str:
        cut = f"named_struct('m', regexp_extract_all({run}, '{pattern}', 0), 'g', split({run}, '{pattern}', -1))"
        return f"transform(array({cut}), p -> {_spans('entropy', 'p.m', 'p.g', keep, at)})[0]"

    return f"concat({of(stretches, 'true')}, {of(TOKEN, f'p.m[i] rlike {chr(39)}{examples}{chr(39)}')})"


def _let(name: str, values: dict[str, str], body: str) -> str:
    """SQL for ``body`` with a struct ``name`` of values, each made once."""
    fields = ", ".join(f"'{k}', {v}" for k, v in values.items())
    return f"transform(array(named_struct({fields})), {name} -> {body})[0]"


def _quoted(pattern: str) -> str:
    return "r'" + pattern + "'" if "'" not in pattern else 'r"' + pattern + '"' if '"' not in pattern else "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(t: str, window: int, allow: tuple[str, ...], stretches: str, examples: str) -> str:
    """SQL: the sorted spans of the text ``t``."""
    access, hexes, runs = f"AKIA[A-Z0-9]{{{LEAST['access'] - 4},}}", f"[0-9a-f]{{{LEAST['hex']},}}", f"{RUN}{{{window},}}"
    hits = {
        "assign": f"regexp_extract_all({t}, {_quoted(ASSIGN)}, 0)",
        # a run of 20, or 24, holds the same matches as a run of any length that is then measured
        "access": f"if(contains({t}, 'AKIA'), regexp_extract_all({t}, '{access}', 0), cast(array() as array<string>))",
        "hexes": f"regexp_extract_all({t}, '{hexes}', 0)",
        "run": f"regexp_extract_all({t}, '{runs}', 0)",
    }
    gaps = {f"{name}_gaps": f"if(size(m.{name}) > 0, split({t}, {_quoted(pattern)}, -1), null)" for name, pattern in (("assign", ASSIGN), ("access", access), ("hexes", hexes), ("run", runs))}
    gaps["value"] = f"if(size(m.assign) > 0, regexp_extract_all({t}, {_quoted(ASSIGN)}, 2), null)"
    base = ", ".join((_spans("assign", "m.assign", "g.assign_gaps", f"length(g.value[i]) >= {LEAST['assign']}"), _spans("access", "m.access", "g.access_gaps", "true"), _spans("hex", "m.hexes", "g.hexes_gaps", "true")))
    # a run with a class has a letter and a digit, and so has any piece with one
    long_runs = _spans("entropy", "m.run", "g.run_gaps", "m.run[i] rlike '[0-9]' and m.run[i] rlike '[A-Za-z]'")
    span = lambda start, stop: f"array(named_struct('start', {start}, 'rank', x.rank, 'stop', {stop}, 'kind', x.kind))"
    left = f"""flatten(transform(s.more, x -> aggregate(
        array_sort(concat(filter(s.base, b -> b.start < x.stop and x.start < b.stop), {_allowed(f'substring({t}, x.start + 1, x.stop - x.start)', 'x.start', stretches, examples)})),
        named_struct('at', x.start, 'out', cast(array() as array<{SPAN}>)),
        (acc, b) -> named_struct('at', greatest(acc.at, b.stop), 'out', if(b.start > acc.at, concat(acc.out, {span('acc.at', 'b.start')}), acc.out)),
        acc -> if(acc.at < x.stop, concat(acc.out, {span('acc.at', 'x.stop')}), acc.out))))"""
    allowed = " or ".join(["false"] + [f"h rlike '{p}'" for p in allow])
    piece = f"substring({t}, x.start + 1, x.stop - x.start)"
    judged = f"exists(array({piece}), h -> ({_class('h')}) is not null and not ({allowed}))"
    slid = f"""filter(transform(k.kept, x -> transform(array({_slide(piece, f'({_class(piece)})', window)}), w -> named_struct(
        'start', x.start + w.first, 'rank', x.rank, 'stop', x.start + w.last + {window}, 'kind', x.kind))[0]),
        y -> y.start is not null)"""
    none = f"cast(array() as array<{SPAN}>)"
    kept = f"if(size(s.more) = 0, {none}, filter({left}, x -> x.stop - x.start >= {window} and {judged}))"
    sorted_ = f"array_sort(concat(s.base, if(size(k.kept) = 0, {none}, {slid})))"
    whole = _let("s", {"base": f"concat({base})", "more": long_runs}, _let("k", {"kept": kept}, sorted_))
    any_hit = "size(m.assign) + size(m.access) + size(m.hexes) + size(m.run) > 0"
    return _let("m", hits, f"if({any_hit}, {_let('g', gaps, whole)}, {none})")


def _pieces(text: str) -> str:
    """SQL: array of (at, t), the pieces of a text with their places."""
    cut = f"regexp_extract_all({text}, {_quoted(f'(?s).{{1,{PIECE}}}(?:$|.*?(?:{CUT}|$))')}, 0)"
    listed = f"""aggregate({cut}, named_struct('at', 0, 'out', cast(array() as array<struct<at:int,t:string>>)),
        (acc, p) -> named_struct('at', acc.at + length(p), 'out', concat(acc.out, array(named_struct('at', acc.at, 't', p)))), acc -> acc.out)"""
    return f"if(length({text}) <= {2 * PIECE}, array(named_struct('at', 0, 't', {text})), {listed})"


def scan(
    df: DataFrame, text_col: str = "text", out: str = "secret_spans", window: int = WINDOW, allow: tuple[str, ...] = ALLOW, stretches: str = STRETCHES, examples: str = EXAMPLES
) -> DataFrame:
    """Adds ``out``: array of spans (start, rank, stop, kind), by start, then kind as in KINDS. No shuffle, no Python."""
    return _by_piece(df, text_col, out, window, allow, stretches, examples, "spans", "u.at")


def _by_piece(df: DataFrame, text_col: str, out: str, window: int, allow: tuple[str, ...], stretches: str, examples: str, what: str, at: str) -> DataFrame:
    name = f"_{out}_text"
    spans = _found("u.t", window, allow, stretches, examples)
    moved = f"transform({spans}, x -> named_struct('start', x.start + {at}, 'rank', x.rank, 'stop', x.stop + {at}, 'kind', x.kind))"
    found = df.withColumn(name, common.text_or_empty(f"`{text_col}`"))
    each = f"transform({_pieces(f'`{name}`')}, u -> {moved if what == 'spans' else what.format(spans=spans)})"
    return found.withColumn(out, F.expr(f"flatten({each})" if what == "spans" else f"array_join({each}, '')")).drop(name)


def line(spans: str, kinds: tuple[str, ...] = KINDS) -> Column:
    """``kind:start:stop`` of the spans of ``kinds``, comma-joined in their order."""
    listed = ", ".join(f"'{k}'" for k in kinds)
    return F.expr(f"array_join(transform(filter({spans}, x -> x.kind in ({listed})), x -> concat(x.kind, ':', x.start, ':', x.stop)), ',')")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans)."""
    found = scan(df.select(F.col(id_col), F.col(text_col)), text_col)
    counts = {f"n_{k}": F.expr(f"cast(size(filter(secret_spans, x -> x.kind = '{k}')) as bigint)") for k in KINDS[:3]}
    return found.select(id_col, *[c.alias(k) for k, c in counts.items()], F.sha2(line("secret_spans", KINDS[:3]), 256).alias("base_sha256"), line("secret_spans").alias("spans"))


def redact(df: DataFrame, text_col: str = "text", marker: str = "[SECRET]") -> DataFrame:
    """Replaces every span by ``marker``; overlapping spans become one. Null texts stay null; other columns stay, whatever their names."""
    cut = f"""aggregate({{spans}}, named_struct('out', '', 'at', 0), (acc, x) -> if(x.stop <= acc.at, acc, named_struct(
        'out', concat(acc.out, if(x.start >= acc.at, concat(substring(u.t, acc.at + 1, x.start - acc.at), '{marker}'), '')), 'at', x.stop)),
        acc -> concat(acc.out, substring(u.t, acc.at + 1)))"""
    packed = df.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    found = _by_piece(packed, "text", "clean", WINDOW, ALLOW, STRETCHES, EXAMPLES, cut, "0")
    text = F.when(F.col("text").isNull() | (F.col("clean") == F.col("text")), F.col(f"row.`{text_col}`")).otherwise(F.col("clean"))
    return found.select(F.col("row").withField(f"`{text_col}`", text).alias("row")).select("row.*")


def oracle() -> str:
    """DuckDB SQL for ``report`` over ``documents``, by other means: windows' entropies are computed anew."""
    base = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    q = lambda s: s.replace("'", "''")
    least = {"assign": f"length(regexp_extract(h, '{q(ASSIGN)}', 2)) >= {LEAST['assign']}", "access": f"length(h) >= {LEAST['access']}", "hex": f"length(h) >= {LEAST['hex']}"}
    run = f"{RUN}+"
    level = f"""CASE WHEN regexp_full_match(h, '[0-9a-f]+|[0-9A-F]+') THEN CASE WHEN regexp_matches(h, '[0-9]') AND regexp_matches(h, '[A-Fa-f]') THEN {THRESHOLDS['hex']} END
        WHEN regexp_matches(h, '[0-9]') AND regexp_matches(h, '[A-Z]') AND regexp_matches(h, '[a-z]') THEN {THRESHOLDS['both_cases']}
        WHEN regexp_matches(h, '[0-9]') AND regexp_matches(h, '[A-Za-z]') THEN {THRESHOLDS['one_case']} END"""
    allow = " OR ".join(f"regexp_matches(h, '{q(p)}')" for p in ALLOW)

    def hits(pattern: str, table: str = "docs") -> str:
        return f"""(SELECT r, s, s + length(h) AS e, h FROM (
            SELECT r, h, list_sum(list_transform(g[1:i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::BIGINT AS s
            FROM (SELECT r, m, g, unnest(m) AS h, generate_subscripts(m, 1) AS i FROM (
                SELECT r, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS g FROM {table}) WHERE len(m) > 0)))"""

    parts = [f"SELECT r, {rank} AS rank, '{kind}' AS kind, s, e FROM {hits(q(pattern))} WHERE {least[kind]}" for rank, (kind, pattern) in enumerate(base.items())]
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        base AS ({' UNION ALL '.join(parts)}),
        whole AS (SELECT row_number() OVER () AS r, r AS doc, s AS o, e, h AS text FROM {hits(q(run))} WHERE length(h) >= {WINDOW} AND regexp_matches(h, '[0-9]') AND regexp_matches(h, '[A-Za-z]')),
        named AS (SELECT r, s, e FROM {hits(STRETCHES, 'whole')} UNION ALL SELECT r, s, e FROM {hits(TOKEN, 'whole')} WHERE regexp_matches(h, '{EXAMPLES}')),
        cuts AS (SELECT whole.r, base.s, base.e FROM whole JOIN base ON base.r = whole.doc AND base.s < whole.e AND base.e > whole.o UNION ALL SELECT whole.r, o + named.s, o + named.e FROM named JOIN whole USING (r)),
        starts AS (SELECT r, o AS p FROM whole UNION SELECT r, e AS p FROM cuts),
        pieces AS (SELECT whole.doc AS r, p AS s, least(any_value(whole.e), coalesce(min(cuts.s) FILTER (cuts.s >= p), any_value(whole.e))) AS e FROM starts JOIN whole USING (r) LEFT JOIN cuts ON cuts.r = whole.r
            GROUP BY whole.r, whole.doc, p HAVING NOT coalesce(bool_or(cuts.s <= p AND cuts.e > p), false)),
        runs AS (SELECT r, s, h, level FROM (SELECT r, s, h, {level} AS level FROM (SELECT r, s, substr(text, s::INT + 1, (e - s)::INT) AS h FROM pieces JOIN docs USING (r) WHERE e - s >= {WINDOW})) WHERE level IS NOT NULL AND NOT ({allow})),
        windows AS (SELECT r, s, level, i, list_entropy(string_split(substr(h, i::INT + 1, {WINDOW}), '')) AS bits FROM (SELECT *, unnest(range(0, length(h) - {WINDOW - 1})) AS i FROM runs)),
        slid AS (SELECT r, 3 AS rank, 'entropy' AS kind, s + min(i) AS s, s + max(i) + {WINDOW} AS e FROM (SELECT r, s AS s, i, bits, level FROM windows) WHERE bits >= level GROUP BY r, s),
        every AS (SELECT * FROM base UNION ALL SELECT * FROM slid),
        listed AS (SELECT r, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base_spans,
            count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex FROM every GROUP BY r)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN listed USING (r)"""

"""Porter stemmer (N6) as column expressions.

The 1980 published algorithm, written as one ``CASE`` per step over the suffix rules below. Each step
is its own projection: a step mentions its input several times, and keeping steps apart keeps the
expression tree linear (Catalyst does not collapse projections that would duplicate non-trivial
expressions, and whole-stage codegen still pipelines them).

The same rule tables render the SQL used by the oracle (``quarry.plans.oracle``), so both engines run
the same algorithm. Only ASCII vowels count as vowels; any other character is a consonant.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The suffix rules of the published 1980 algorithm, steps 2, 3 and 4.
STEP2_RULES = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
]
STEP3_RULES = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
]
STEP4_SUFFIXES = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]

# Measure conditions as regular expressions over a stem.  C: a run of consonants, V: a run of vowels,
# where y after a consonant is a vowel.  m > 0 is [C]VC..., m = 1 is [C]VC[V], m > 1 is [C]VCVC...
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"
M_GT0 = f"^({_C})?{_V}{_C}"
M_EQ1 = f"^({_C})?{_V}{_C}({_V})?$"
M_GT1 = f"^({_C})?{_V}{_C}{_V}{_C}"
HAS_VOWEL = f"^({_C})?[aeiouy]"
CVC = f"^{_C}[aeiouy][^aeiouwxy]$"          # *o together with m = 1
DOUBLE_END = "(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$"  # *d, not l, s or z
ENDS_ST = "[st]$"

MIN_LENGTH = 3   # words shorter than this are returned unchanged


def _rule_list(rules):
    """Longest suffix first; the first suffix that matches decides, even if its condition fails."""
    return sorted(rules, key=lambda r: -len(r[0]))


def step_rules():
    """The rule tables as (step, suffix, replacement, condition) tuples; conditions are names of the
    regexes above (or ``None``), applied to the stem left after removing the suffix."""
    s1a = [("1a", "sses", "ss", None), ("1a", "ies", "i", None), ("1a", "ss", "ss", None),
           ("1a", "s", "", None)]
    s2 = [("2", s, r, "M_GT0") for s, r in _rule_list(STEP2_RULES)]
    s3 = [("3", s, r, "M_GT0") for s, r in _rule_list(STEP3_RULES)]
    s4 = [("4", s, "", "M_GT1_ST" if s == "ion" else "M_GT1")
          for s, _ in _rule_list([(x, "") for x in STEP4_SUFFIXES])]
    return {"1a": s1a, "2": s2, "3": s3, "4": s4}


# ----------------------------------------------------------------------------------------------
# Spark column rendering

def _stem(w: Column, k: int) -> Column:
    return F.left(w, F.length(w) - F.lit(k))


def _cond(name: str | None, stem: Column) -> Column:
    if name is None:
        return F.lit(True)
    if name == "M_GT1_ST":
        return stem.rlike(M_GT1) & stem.rlike(ENDS_ST)
    return stem.rlike(globals()[name])


def _suffix_index(w: Column, rules) -> Column:
    """1-based index of the first rule whose suffix ends ``w`` (0 if none)."""
    expr = None
    for i, (_, suffix, _, _) in enumerate(rules, start=1):
        expr = F.when(w.endswith(suffix), F.lit(i)) if expr is None else expr.when(w.endswith(suffix), F.lit(i))
    return expr.otherwise(F.lit(0))


def _suffix_apply(w: Column, idx: Column, rules) -> Column:
    """Apply rule ``idx`` to ``w``: strip its suffix, and if the rule's condition holds on the stem,
    append the replacement. Suffix lengths and replacements are looked up in literal arrays, so the
    generated code does not repeat per rule (it stays small enough for the JIT)."""
    safe = F.greatest(idx, F.lit(1))
    k = F.element_at(F.array(*[F.lit(len(r[1])) for r in rules]), safe)
    repl = F.element_at(F.array(*[F.lit(r[2]) for r in rules]), safe)
    stem = F.left(w, F.length(w) - k)
    conds = {r[3] for r in rules}
    if conds == {None}:
        ok = F.lit(True)
    elif conds == {"M_GT0"}:
        ok = stem.rlike(M_GT0)
    elif conds == {"M_GT1", "M_GT1_ST"}:
        ion = F.array(*[F.lit(r[3] == "M_GT1_ST") for r in rules])
        ok = stem.rlike(M_GT1) & (~F.element_at(ion, safe) | stem.rlike(ENDS_ST))
    else:
        raise ValueError(f"unsupported rule conditions {conds}")
    return F.when((idx > 0) & ok, F.concat(stem, repl)).otherwise(w)


def porter_stem(df: DataFrame, in_col: str, out_col: str | None = None) -> DataFrame:
    """Add ``out_col`` (default: overwrite ``in_col``) holding the Porter stem of ``in_col``.

    Applied as a chain of projections (whole-stage code generated, no shuffle); columns other than
    ``in_col``/``out_col`` pass through.
    """
    out_col = out_col or in_col
    rules = step_rules()
    w, f = "__pw", "__pf"
    others = [c for c in df.columns if c not in (out_col, w, f)]
    cur = df.select(*others, F.col(in_col).alias("__orig"), F.col(in_col).alias(w))
    keep = others + ["__orig"]

    def proj(expr_w, expr_f=None):
        cols = [F.col(c) for c in keep] + [expr_w.alias(w)]
        if expr_f is not None:
            cols.append(expr_f.alias(f))
        return cols

    W = F.col(w)
    I = F.col("__pi")

    def suffix_step(cur, step_rules):
        cur = cur.select(*[F.col(c) for c in keep], W, _suffix_index(W, step_rules).alias("__pi"))
        return cur.select(*proj(_suffix_apply(W, I, step_rules)))

    cur = suffix_step(cur, rules["1a"])
    # Step 1b: eed (m>0) -> ee; ed / ing (stem has a vowel) -> stem, flagged for the fix-up step.
    s_eed, s_ed, s_ing = _stem(W, 3), _stem(W, 2), _stem(W, 3)
    w1b = (F.when(W.endswith("eed"), F.when(s_eed.rlike(M_GT0), F.concat(s_eed, F.lit("ee"))).otherwise(W))
           .when(W.endswith("ed") & s_ed.rlike(HAS_VOWEL), s_ed)
           .when(W.endswith("ing") & s_ing.rlike(HAS_VOWEL), s_ing)
           .otherwise(W))
    f1b = (~W.endswith("eed")) & ((W.endswith("ed") & s_ed.rlike(HAS_VOWEL))
                                  | (W.endswith("ing") & s_ing.rlike(HAS_VOWEL)))
    cur = cur.select(*proj(w1b, F.coalesce(f1b, F.lit(False))))
    F_ = F.col(f)
    fix = (F.when(W.endswith("at") | W.endswith("bl") | W.endswith("iz"), F.concat(W, F.lit("e")))
           .when(W.rlike(DOUBLE_END), _stem(W, 1))
           .when(W.rlike(CVC), F.concat(W, F.lit("e")))
           .otherwise(W))
    cur = cur.select(*proj(F.when(F_, fix).otherwise(W)))
    # Step 1c: y -> i when the stem has a vowel.
    s_y = _stem(W, 1)
    cur = cur.select(*proj(F.when(W.endswith("y") & s_y.rlike(HAS_VOWEL), F.concat(s_y, F.lit("i")))
                           .otherwise(W)))
    for step in ("2", "3", "4"):
        cur = suffix_step(cur, rules[step])
    # Step 5a: remove a final e if m>1, or m=1 and not *o.
    s_e = _stem(W, 1)
    cur = cur.select(*proj(F.when(W.endswith("e") & (s_e.rlike(M_GT1) | (s_e.rlike(M_EQ1) & ~s_e.rlike(CVC))),
                                  s_e).otherwise(W)))
    # Step 5b: ll -> l when m>1.
    cur = cur.select(*proj(F.when(W.endswith("ll") & W.rlike(M_GT1), _stem(W, 1)).otherwise(W)))
    orig = F.col("__orig")
    result = F.when(F.length(orig) < MIN_LENGTH, orig).otherwise(W)
    # Optimization fence: a filter on the stem (an inferred ``isnotnull`` of a join key, an equality
    # lookup) must not be pushed into the step projections, where inlining each step into the next
    # would grow the expression exponentially. Filters cannot move below a generator's output, so
    # the stem leaves through a one-element explode.
    return cur.select(*[F.col(c) for c in others], F.explode(F.array(result)).alias(out_col))


# ----------------------------------------------------------------------------------------------
# A word at a time (same rules), for tasks that look at each of their distinct words once.

def word_stemmer() -> Callable[[str], str]:
    """The stem of one word. The function carries all it needs, so executors do not have to have this package."""
    rules = {step: [(s, r, {None: None, "M_GT0": M_GT0, "M_GT1": M_GT1, "M_GT1_ST": M_GT1}[c], c == "M_GT1_ST") for _, s, r, c in listed]
             for step, listed in step_rules().items()}
    suffixes = {step: tuple(r[0] for r in listed) for step, listed in rules.items()}
    m_gt0, m_eq1, m_gt1, has_vowel, cvc, double_end = (re.compile(x) for x in (M_GT0, M_EQ1, M_GT1, HAS_VOWEL, CVC, DOUBLE_END))
    conds = {M_GT0: m_gt0, M_GT1: m_gt1}
    shortest = MIN_LENGTH

    def step(w: str, name: str) -> str:
        if not w.endswith(suffixes[name]):
            return w
        for suffix, repl, cond, after_st in rules[name]:
            if w.endswith(suffix):
                stem = w[:len(w) - len(suffix)]
                ok = (cond is None or conds[cond].search(stem)) and (not after_st or stem.endswith(("s", "t")))
                return stem + repl if ok else w
        return w

    def stem(word: str) -> str:
        if len(word) < shortest:
            return word
        w = step(word, "1a")
        if w.endswith("eed"):
            w = w[:-1] if m_gt0.search(w[:-3]) else w
        else:
            cut = w[:-2] if w.endswith("ed") else w[:-3] if w.endswith("ing") else ""
            if has_vowel.search(cut):
                w = cut
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif double_end.search(w):
                    w = w[:-1]
                elif cvc.search(w):
                    w += "e"
        if w.endswith("y") and has_vowel.search(w[:-1]):
            w = w[:-1] + "i"
        for name in ("2", "3", "4"):
            w = step(w, name)
        if w.endswith("e") and (m_gt1.search(w[:-1]) or (m_eq1.search(w[:-1]) and not cvc.search(w[:-1]))):
            w = w[:-1]
        return w[:-1] if w.endswith("ll") and m_gt1.search(w) else w

    return stem


# ----------------------------------------------------------------------------------------------
# SQL rendering (same rules), used by the DuckDB oracle.

def _sql_stem(w: str, k: int) -> str:
    return f"left({w}, length({w}) - {k})"


def _sql_like(expr: str, pattern: str, fn: str) -> str:
    return f"{fn}({expr}, '{pattern}')"


def _sql_cond(name, stem, fn):
    if name == "M_GT1_ST":
        return f"({_sql_like(stem, M_GT1, fn)} AND {_sql_like(stem, ENDS_ST, fn)})"
    return _sql_like(stem, globals()[name], fn)


def _sql_suffix_case(w: str, rules, fn: str) -> str:
    parts = []
    for _, suffix, repl, cond in rules:
        stem = _sql_stem(w, len(suffix))
        out = f"{stem} || '{repl}'" if repl else stem
        value = f"CASE WHEN {_sql_cond(cond, stem, fn)} THEN {out} ELSE {w} END" if cond else out
        parts.append(f"WHEN suffix({w}, '{suffix}') THEN {value}")
    return "CASE " + " ".join(parts) + f" ELSE {w} END"


def porter_sql(source: str, in_col: str, out_col: str, fn: str = "regexp_matches") -> str:
    """A SQL query over ``source`` (a table/CTE with column ``in_col``) returning
    ``(in_col, out_col)`` with the Porter stem. Each step is a nested subquery."""
    rules = step_rules()
    w = "w"
    q = f"SELECT {in_col} AS t, {in_col} AS w FROM {source}"

    def wrap(q, expr, extra=""):
        return f"SELECT t, {expr} AS w{extra} FROM ({q})"

    q = wrap(q, _sql_suffix_case(w, rules["1a"], fn))
    s_eed, s_ed, s_ing = _sql_stem(w, 3), _sql_stem(w, 2), _sql_stem(w, 3)
    c_ed = f"(suffix(w, 'ed') AND {_sql_like(s_ed, HAS_VOWEL, fn)})"
    c_ing = f"(suffix(w, 'ing') AND {_sql_like(s_ing, HAS_VOWEL, fn)})"
    w1b = (f"CASE WHEN suffix(w, 'eed') THEN CASE WHEN {_sql_like(s_eed, M_GT0, fn)} THEN {s_eed} || 'ee' ELSE w END "
           f"WHEN {c_ed} THEN {s_ed} WHEN {c_ing} THEN {s_ing} ELSE w END")
    f1b = f"(NOT suffix(w, 'eed') AND ({c_ed} OR {c_ing}))"
    q = wrap(q, w1b, f", coalesce({f1b}, false) AS f")
    fix = (f"CASE WHEN suffix(w, 'at') OR suffix(w, 'bl') OR suffix(w, 'iz') THEN w || 'e' "
           f"WHEN {_sql_like('w', DOUBLE_END, fn)} THEN {_sql_stem('w', 1)} "
           f"WHEN {_sql_like('w', CVC, fn)} THEN w || 'e' ELSE w END")
    q = wrap(q, f"CASE WHEN f THEN {fix} ELSE w END")
    s_y = _sql_stem(w, 1)
    q = wrap(q, f"CASE WHEN suffix(w, 'y') AND {_sql_like(s_y, HAS_VOWEL, fn)} THEN {s_y} || 'i' ELSE w END")
    for step in ("2", "3", "4"):
        q = wrap(q, _sql_suffix_case(w, rules[step], fn))
    s_e = _sql_stem(w, 1)
    q = wrap(q, f"CASE WHEN suffix(w, 'e') AND ({_sql_like(s_e, M_GT1, fn)} OR ({_sql_like(s_e, M_EQ1, fn)} "
                f"AND NOT {_sql_like(s_e, CVC, fn)})) THEN {s_e} ELSE w END")
    q = wrap(q, f"CASE WHEN suffix(w, 'll') AND {_sql_like('w', M_GT1, fn)} THEN {_sql_stem('w', 1)} ELSE w END")
    return (f"SELECT t AS {in_col}, CASE WHEN length(t) < {MIN_LENGTH} THEN t ELSE w END AS {out_col} "
            f"FROM ({q})")

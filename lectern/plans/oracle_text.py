"""DuckDB SQL forms of the text operators, used only by the oracle queries.

DuckDB's RE2 has no lookaround and an ASCII ``\\s``, so the rules are restated:
whitespace is spelled out as the Java ``White_Space`` set (what Spark's
``(?U)\\s`` matches) and the lookaround steps become ordered rewrites.
These builders return SQL text; they are string templates, not a parser.
"""

from __future__ import annotations

# Python's white space, as code points.
_WS_CODES = [9, 10, 11, 12, 13, 0x1C, 0x1D, 0x1E, 0x1F, 32, 0x85, 0xA0, 0x1680] + list(range(0x2000, 0x200B)) + [
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _cls(codes, negate=False) -> str:
    body = "".join("\\x{%X}" % c for c in codes)
    return "[%s%s]" % ("^" if negate else "", body)


S = _cls(_WS_CODES)                                  # any whitespace
W = _cls([c for c in _WS_CODES if c != 10])          # whitespace but newline
N = _cls(_WS_CODES, negate=True)                     # not whitespace
D = r"\p{Nd}"                                        # Unicode decimal digit
WS_CHARS = " || ".join("chr(%d)" % c for c in _WS_CODES)


def q(s: str) -> str:
    """Quote a SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rr(expr: str, pattern: str, repl: str, flags: str = "g") -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(repl)}, {q(flags)})"


def upper(expr: str) -> str:
    """Upper case as Java and Python do it: "ß" becomes "SS" (DuckDB gives "ẞ")."""
    return f"upper(replace({expr}, 'ß', 'SS'))"


def strip(expr: str) -> str:
    """Python ``str.strip()`` over the Java whitespace set."""
    return f"trim({expr}, {WS_CHARS})"


def clean_text(expr: str) -> str:
    """F1 without lookaround.

    Steps: drop trailing whitespace; drop a leading run that is blank or a
    single newline plus blanks; then
    per run, in this order: a run holding ``\\n\\n`` (with only non-newline
    whitespace after it) vanishes; ``\\n`` plus two or more blanks keeps the
    last blank; ``\\n`` plus one blank vanishes; blanks before a newline
    vanish; blank runs keep their last character.  Finally single newlines
    become spaces unless an option marker follows.
    """
    e = rr(expr, S + r"+\z", "")
    e = rr(e, r"\A" + W + "+(" + N + ")", r"\1")
    e = rr(e, r"\A\n" + W + "*(" + N + ")", r"\1")
    e = rr(e, S + r"*\n\n" + W + "*", "")
    e = rr(e, S + r"*\n" + W + "+(" + W + ")", r"\1")
    e = rr(e, S + r"*\n" + W, "")
    e = rr(e, W + r"+\n", "\n")
    e = rr(e, W + "+(" + W + ")", r"\1")
    e = f"replace({e}, 'ѐ', 'ё')"
    e = rr(e, r"\n([1234567АБВГД]\))", "\x01\\1")
    e = f"replace(replace({e}, chr(10), ' '), chr(1), chr(10))"
    return e


def strip_footnotes(expr: str) -> str:
    """F2."""
    e = rr(expr, S + "*ДРТ–" + D + "+" + S + r"*г\." + S + "*", "")
    return rr(e, S + "*" + D + "+" + S + r"*\z", "")


def reorder_options(src: str, col: str, out: str) -> str:
    """F3 as nested subqueries over ``src`` adding column ``out``.

    Options are split by marking each ``<digits>)`` with ``chr(1)``.
    """
    s1 = f"SELECT *, strpos({col}, '1)') AS _p FROM ({src}) _s1"
    s2 = (f"SELECT *, {strip(f'substr({col}, 1, _p - 1)')} AS _stem, "
          f"string_split({rr(strip(f'substr({col}, _p)'), '(' + D + r'+\))', chr(1) + r'\1')}, chr(1)) AS _parts "
          f"FROM ({s1}) _s2")
    s3 = ("SELECT *, list_slice(_parts, 2, len(_parts)) AS _pieces, "
          f"regexp_extract(_parts[-1], {q('^([^;.]*[;.])')}, 1) AS _head FROM ({s2}) _s3")
    tail = strip("substr(_pieces[-1], length(_head) + 1)")
    piece = strip("CASE WHEN _i = len(_pieces) AND _head <> '' THEN _head ELSE _x END")
    # digits of any length and script: by length without leading zeros, then digit by digit
    other = "".join(c for c in map(chr, range(0x80, 0x110000)) if c.isdecimal())
    digits = f"ltrim(translate(regexp_extract(_x, {q(D + '+')}), '{other}', '{''.join(str(int(c)) for c in other)}'), '0')"
    num = f"{{'len': length({digits}), 'digits': {digits}}}"
    s4 = (f"SELECT *, CASE WHEN _head = '' THEN '' ELSE {tail} END AS _tail, "
          "array_to_string(list_transform(list_sort(list_transform(_pieces, lambda _x, _i: "
          f"{{'num': {num}, 'pos': _i, 'text': {piece}}})), lambda _o: _o.text), chr(10)) AS _body "
          f"FROM ({s3}) _s4")
    s5 = (f"SELECT * EXCLUDE (_p, _stem, _parts, _pieces, _head, _tail, _body), "
          f"CASE WHEN _p = 0 THEN {col} ELSE _stem || chr(10) || _body || "
          f"CASE WHEN _tail <> '' THEN chr(10) || _tail ELSE '' END END AS {out} FROM ({s4}) _s5")
    return s5

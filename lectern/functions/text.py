"""Text operators as native Spark column expressions.

Every builder takes and returns a ``Column``; nothing here leaves the JVM.
Java regex flags used throughout: ``U`` gives Unicode ``\\s``/``\\d`` (Python's
default for str patterns), ``d`` makes ``\\n`` the only line terminator, ``m``
makes ``^``/``$`` work per line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the source rules for equal results; the
# patterns are the source's, written in Java syntax with the flags that give
# Python's meaning (U: Unicode \s and \d; d: only \n ends a line; m: ^ and $
# per line).
#   option markers that keep their preceding newline: 1 2 3 4 5 6 7 А Б В Г Д
#   (the letters are Cyrillic U+0410, U+0411, U+0412, U+0413, U+0414)
#   the e-grave fix: "ѐ" (U+0450) becomes "ё" (U+0451)
#   exam footer: "ДРТ–<digits> г." with an en dash (U+2013)
#   answer prefix in consult blocks: "Ответ:"
#   question id at the start of a consult block: Cyrillic А or В, digits, a dot
PROTECTED_MARKERS = "1234567АБВГД"
E_GRAVE = "ѐ"
E_DIAERESIS = "ё"
WS_CLASS = r"[\s\x1c-\x1f]"      # Python's \s: Unicode white space and the four separators U+001C-U+001F
WS_RUNS_PATTERN = rf"(?dmU){WS_CLASS}+$|^{WS_CLASS}+|{WS_CLASS}+(?={WS_CLASS})"
UNWRAP_PATTERN = rf"(?U)(?<!\n)\n(?!\n)(?![{PROTECTED_MARKERS}]\))"
FOOTER_PATTERN = rf"(?U){WS_CLASS}*ДРТ–\d+{WS_CLASS}*г\.{WS_CLASS}*"
TRAILING_NUMBER_PATTERN = rf"(?U){WS_CLASS}*\d+{WS_CLASS}*\z"
OPTION_PIECE_PATTERN = r"(?U)(\d+\)[\s\S]*?(?=\d+\)|\z))"
OPTION_END_PATTERN = "[;.]"
ANSWER_PATTERN = rf"(?dU)Ответ:{WS_CLASS}*(.+)"
BLOCK_QID_PATTERN = r"(?U)\A([АВ]\d+)\."
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters of WS_CLASS as one string.
WHITESPACE = "".join(chr(c) for c in [9, 10, 11, 12, 13, 0x1C, 0x1D, 0x1E, 0x1F, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                        0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def strip(c) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends.

    Spark's one-argument ``trim`` removes only the space character; ``btrim``
    with the whole whitespace set does what ``strip`` does, without a regex.
    """
    return F.btrim(_col(c), F.lit(WHITESPACE))


def clean_text(c) -> Column:
    """collapse whitespace runs, fix ``ѐ``, unwrap lines, strip the end.

    * a whitespace run keeps at most one character; a run whose last newline
      follows another newline keeps nothing (``"a\\n\\nb"`` -> ``"ab"``);
    * a single newline becomes a space unless an option marker such as ``1)``
      or ``А)`` follows it;
    * NULL stays NULL.
    """
    c = F.regexp_replace(_col(c), WS_RUNS_PATTERN, "")
    c = F.replace(c, F.lit(E_GRAVE), F.lit(E_DIAERESIS))
    c = F.regexp_replace(c, UNWRAP_PATTERN, " ")
    return F.rtrim(c, F.lit(WHITESPACE))


def strip_footnotes(c) -> Column:
    """drop every ``ДРТ–n г.`` footer with its surrounding whitespace, then
    any trailing number (``"Question 1"`` -> ``"Question"``)."""
    c = F.regexp_replace(_col(c), FOOTER_PATTERN, "")
    return F.regexp_replace(c, TRAILING_NUMBER_PATTERN, "")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.

    Spark does not share repeated subexpressions inside lambdas or
    conditional branches, so an input used several times (a cleaned text, an
    array of pieces) would be recomputed for every use.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


# Decimal digits of other scripts and the ASCII digits they stand for.
OTHER_DIGITS = "".join(ch for ch in map(chr, range(0x80, 0x110000)) if ch.isdecimal())
ASCII_DIGITS = "".join(str(int(ch)) for ch in OTHER_DIGITS)


def number_key(digits: Column) -> Column:
    """A sort key for a run of decimal digits of any length and script that
    orders like the number: (digits without leading zeros, counted; digits)."""
    plain = F.when(digits.rlike(r"\A[0-9]*\z"), digits).otherwise(F.translate(digits, OTHER_DIGITS, ASCII_DIGITS))
    return let(F.ltrim(plain, F.lit("0")), lambda d: F.struct(F.length(d).alias("len"), d.alias("digits")))


def reorder_options(c) -> Column:
    """Sort numbered options ``n)`` by number.

    The stem is everything before the first ``1)`` (which may sit inside
    ``11)``).  The option pieces each start at a ``<digits>)`` marker.  The
    piece that comes last by position is cut after its first ``;`` or ``.``;
    the rest becomes a tail on its own line.  Pieces are sorted by number,
    stably, and joined by newlines.  Text without ``1)`` is returned as is.
    """
    def on_text(t):
        start = F.instr(t, "1)")
        stem = strip(t.substr(F.lit(1), start - 1))
        opts = strip(t.substr(start, F.length(t)))

        def on_pieces(pieces):
            last_idx = F.size(pieces) - 1

            def on_last(last):
                cut = F.regexp_instr(last, F.lit(OPTION_END_PATTERN))
                head = F.when(cut > 0, last.substr(F.lit(1), cut)).otherwise(last)
                tail = F.when(cut > 0, strip(last.substr(cut + 1, F.length(last)))).otherwise(F.lit(""))
                keyed = F.transform(pieces, lambda x, i: F.struct(
                    number_key(F.regexp_extract(x, r"(?U)\d+", 0)).alias("num"),
                    i.alias("pos"),
                    strip(F.when(i == last_idx, head).otherwise(x)).alias("text")))
                body = F.array_join(F.transform(F.array_sort(keyed), lambda o: o["text"]), "\n")
                return F.concat(stem, F.lit("\n"), body,
                                F.when(tail != "", F.concat(F.lit("\n"), tail)).otherwise(F.lit("")))
            return let(F.try_element_at(pieces, F.lit(-1)), on_last)

        return F.when(start == 0, t).otherwise(
            let(F.regexp_extract_all(opts, F.lit(OPTION_PIECE_PATTERN), 1), on_pieces))
    return let(_col(c), on_text)


def normalise_question(c) -> Column:
    """footers off, whitespace cleaned, options sorted."""
    return reorder_options(clean_text(strip_footnotes(c)))


def answer_text(c) -> Column:
    """text after ``Ответ:`` to the end of its line, stripped, upper-cased
    and cleaned; NULL when the block holds no answer."""
    raw = F.regexp_extract(_col(c), ANSWER_PATTERN, 1)   # "" when absent; the group is never empty
    return F.when(raw != "", clean_text(strip(F.upper(strip(raw)))))


def block_question_id(c, pattern: str = BLOCK_QID_PATTERN) -> Column:
    """question id at the very start of a block, followed by a dot; NULL
    when absent."""
    qid = F.regexp_extract(_col(c), pattern, 1)
    return F.when(qid != "", qid)


# Fixed value: the step-by-step prompt template of the evaluation task.
COT_TEMPLATE = (
    "{prompt}\n\nBefore answering, reason in a step-by-step manner to get the right answer. "
    "Provide your answer (in the requested format and language) at the end on its own line "
    "in the form \"ANSWER: $ANSWER\" (without quotes) where $ANSWER is the answer to the question."
)


def prompt_text(c, template: str = COT_TEMPLATE) -> Column:
    """Put the question into the template.  ``replace`` is literal, so a
    ``$`` in the data or the template is kept as it is."""
    return F.replace(F.lit(template), F.lit("{prompt}"), _col(c))


def data_uri(content, fmt) -> Column:
    """``data:image/<fmt>;base64,<bytes>``.  Spark's ``base64`` breaks its
    output every 76 characters; the breaks are removed."""
    b64 = F.regexp_replace(F.base64(_col(content)), r"[\r\n]", "")
    return F.concat(F.lit("data:image/"), _col(fmt), F.lit(";base64,"), b64)


def image_file_name(page_no, img_no, fmt) -> Column:
    """``page{p}_img{i}.{ext}`` with 1-based page and image numbers."""
    return F.format_string("page%d_img%d.%s", _col(page_no), _col(img_no), _col(fmt))

"""Quality rules: a table of thresholds compiled into one projection, without user functions.

All figures of a text come from one pass over it: its words are listed once and bound to a
lambda variable, so that no expression is evaluated again for each element. Windows of five words
are compared by 64-bit hashes; texts without a repeated window (nearly all) stop at the
distinct count, others sort their own windows.

Defined results: a null or empty text has no words, fails the base rule and is not kept; all rows
are judged alone, so repeated rows get equal results; extra columns are ignored. A text of which more than half is in scripts
whose languages have no stop words in the list (Thai, Chinese, Korean, Tamil ...) is not judged by them, nor by the length of its
words if its script puts no spaces between them. Languages of listed scripts that the file lacks must be added to it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrweave.llm.shared import WORD_PATTERN

WINDOW = 5
SYMBOLS = "#*$%&|<>"

# Characters of scripts whose languages have no list of stop words, and of those written without spaces between words.
UNSPACED = r"\x{0E00}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}"
UNLISTED = UNSPACED + r"\x{0530}-\x{058F}\x{0700}-\x{08FF}\x{0B00}-\x{0DFF}\x{10A0}-\x{11FF}\x{13A0}-\x{167F}\x{1800}-\x{18AF}\x{AC00}-\x{D7AF}"


def read_stop_words(path: str | Path) -> tuple[str, ...]:
    """Distinct words of a file of lines ``language<TAB>words``; lines that begin with ``#`` are remarks."""
    lines = Path(path).read_text("utf-8").splitlines()
    words = (w for x in lines if x and not x.startswith("#") for w in x.split("\t")[1].split())
    return tuple(dict.fromkeys(words))


#: Frequent function words of some fifty languages (a parameter of the rules).
STOP_WORDS = read_stop_words(Path(__file__).with_name("stop_words.tsv"))


@dataclass(frozen=True)
class Rule:
    """Keep a text only if ``least <= figure <= most``; ``figure`` is SQL over the projected columns. Texts for which
    ``unless``, SQL too, is true are not judged."""

    name: str
    figure: str
    least: float | None = None
    most: float | None = None
    unless: str | None = None

    def passes(self) -> Column:
        figure = F.expr(self.figure)
        ok = F.lit(True)
        if self.least is not None:
            ok = ok & (figure >= F.lit(self.least))
        if self.most is not None:
            ok = ok & (figure <= F.lit(self.most))
        if self.unless is not None:
            ok = ok | F.expr(self.unless)
        return F.coalesce(ok, F.lit(False))


#: The table. Ratios are per word or per line; a text without words has failed the base rule before.
RULES = (
    Rule("words", "n_words", 10, 1_000_000),
    Rule("word_length", "word_chars / nullif(n_words, 0)", 2.0, 15.0, "2 * n_unspaced > word_chars"),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", None, 0.3),
    # one stop word or one repeated line more or less decides nothing in a short text
    Rule("stop_words", "(n_stop_words + 1) / nullif(n_words, 0)", 0.02, None, "2 * n_unlisted > word_chars"),
    Rule("repeated_lines", "(n_dup_lines - 1) / nullif(n_lines, 0)", None, 0.3),
)


def let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _repeat_words(words: str) -> str:
    """SQL: words in windows that occur at least twice in the array ``words``."""
    gram = ", ".join(f"wh[i + {k}]" for k in range(WINDOW))
    grams = let(
        f"transform({words}, w -> xxhash64(w))",
        "wh",
        f"CASE WHEN size(wh) >= {WINDOW} THEN transform(sequence(0, size(wh) - {WINDOW}), i -> xxhash64({gram})) ELSE CAST(array() AS array<bigint>) END",
    )
    twice = "filter(s, (x, i) -> coalesce(get(s, i - 1).h = x.h, false) OR coalesce(get(s, i + 1).h = x.h, false))"
    covered = f"aggregate(transform(p, (x, i) -> coalesce(least(get(p, i + 1) - x, {WINDOW}), {WINDOW})), 0, (a, x) -> a + x)"
    places = let("array_sort(transform(g, (h, i) -> struct(h AS h, i AS i)))", "s", f"array_sort(transform({twice}, x -> x.i))")
    return let(grams, "g", f"CASE WHEN size(array_distinct(g)) = size(g) THEN 0 ELSE {let(places, 'p', covered)} END")


def quality_figures(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = (), stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """``keep`` columns and the figures of every text (longs): n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_stop_words, n_lines, n_unlisted, n_unspaced (characters of such scripts). Names of ``keep`` that are also figures are not supported."""
    stops = ", ".join(f"'{w}'" for w in stop_words)
    word = WORD_PATTERN.replace("\\", "\\\\")
    words = f"regexp_extract_all(__t, '{word}', 0)"
    of_words = f"struct(size(ws) AS n_words, {_repeat_words('ws')} AS n_repeat_words, size(filter(ws, w -> lower(w) IN ({stops}))) AS n_stop_words)"
    lines = f"filter(split(__t, '\\n', -1), l -> l RLIKE '{word}')"
    of_lines = "struct(size(ls) AS n_lines, size(ls) - size(array_distinct(ls)) AS n_dup_lines)"
    d = docs.select(*keep, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__t"))
    # a generator of one row: nothing above it is pushed into (and evaluated within) the lambdas
    d = d.select(*keep, "__t", F.expr(f"inline(array(struct({let(words, 'ws', of_words)} AS w, {let(lines, 'ls', of_lines)} AS l)))"))
    unlisted = F.regexp_replace("__t", f"[^{UNLISTED}]+", "")
    return d.select(
        *keep,
        F.col("w.n_words").cast("bigint").alias("n_words"),
        F.length(F.translate("__t", " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
        (F.length("__t") - F.length(F.translate("__t", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.col("l.n_dup_lines").cast("bigint").alias("n_dup_lines"),
        F.col("w.n_repeat_words").cast("bigint").alias("n_repeat_words"),
        F.col("w.n_stop_words").cast("bigint").alias("n_stop_words"),
        F.col("l.n_lines").cast("bigint").alias("n_lines"),
        F.length(unlisted).cast("bigint").alias("n_unlisted"),
        F.length(F.regexp_replace(unlisted, f"[^{UNSPACED}]+", "")).cast("bigint").alias("n_unspaced"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Figures and verdict of every document: id, figures, ``base_failed``, ``failed`` (names of the rules of the
    table that fail) and ``kept``. A text that fails the base rule is not measured against the table."""
    d = quality_figures(docs, text_col, keep=[id_col]).withColumn("base_failed", base_failed())
    names = F.filter(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    d = d.withColumn("failed", F.when(F.col("base_failed"), F.array(F.lit("base"))).otherwise(names))
    return d.withColumn("kept", F.size("failed") == 0)

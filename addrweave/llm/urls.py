"""URL filter: a weighted vocabulary found by one Aho-Corasick automaton, and rules on hosts and paths.

A term counts only between boundaries (no ASCII letter or digit beside it). One strict term
rejects a url, and so do distinct soft terms whose weights reach ``soft_limit``; a term ``(form|form)`` counts once,
whichever of its forms occur. The vocabulary is a parameter file, ``url_terms.tsv``. A host and path rule that fits
overrides the vocabulary.

Defined results: a null url, or one without ``://``, has an empty host and path, so no rule fits it;
the vocabulary still reads all of it (a null holds no term). Repeated rows get equal results;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from importlib import resources

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PathRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


PATH_RULES = (
    PathRule("block", "net", "/"),
    PathRule("allow", "example.net", "/en/"),
    PathRule("block", "example.com", "/de/"),
    PathRule("allow", "org", "/fr/"),
)

#: Reached by the weights of soft terms, it rejects a url.
SOFT_LIMIT = 2


def read_terms(text: str) -> tuple[tuple[str, ...], dict[str, int]]:
    """Strict terms and weights of soft ones, of a file as described in ``url_terms.tsv``. Forms of a soft entry
    stay together as one term ``(form|form)``."""
    strict, soft = [], {}
    for line in text.splitlines():
        if line.strip() and not line.startswith("#"):
            _, weight, forms = line.split("\t")
            forms = forms.split()
            if weight == "strict":
                strict += forms
            else:
                soft["(" + "|".join(forms) + ")" if forms[1:] else forms[0]] = int(weight)
    return tuple(strict), soft


def forms_of(term: str) -> list[str]:
    return term[1:-1].split("|") if term.startswith("(") and term.endswith(")") else [term]


#: Terms that reject alone, and weights of terms that do so together: the parameter file beside this module.
STRICT_TERMS, SOFT_TERMS = read_terms(resources.files(__package__).joinpath("url_terms.tsv").read_text(encoding="ascii"))


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path (up to ``?`` or ``#``); empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def path_rule(host: Column, path: Column, rules: Sequence[PathRule] = PATH_RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):  # a longer one later wraps the shorter ones
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, F.lit(r.name)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def vocabulary_verdict(url: Column, strict: Sequence[str] = STRICT_TERMS, soft: dict[str, int] = SOFT_TERMS, soft_limit: int = SOFT_LIMIT) -> Column:
    """``block`` or ``allow`` by the vocabulary alone."""
    forms: dict[str, dict[str, int]] = {}  # form -> its terms and their weights
    for term, weight in {**soft, **dict.fromkeys(strict, soft_limit)}.items():
        for form in forms_of(term):
            forms.setdefault(form, {})[term] = weight

    @F.pandas_udf("string")
    def verdict(parts: pd.Series) -> pd.Series:
        machine = ahocorasick.Automaton()
        for form, of in forms.items():
            machine.add_word(form, (len(form), of))
        if forms:
            machine.make_automaton()

        def one(text: str | None) -> str:
            if not text or not forms:
                return "allow"
            text, hits = text.translate(_ASCII_LOWER), {}
            for end, (length, of) in machine.iter(text):
                begin = end - length + 1
                if not (begin and text[begin - 1] in _WORD) and text[end + 1 : end + 2] not in _WORD:
                    hits |= of
            return "block" if sum(hits.values()) >= soft_limit else "allow"

        return parts.map(one, na_action=None)

    return verdict(url)


_WORD = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[PathRule] = PATH_RULES, **vocabulary) -> DataFrame:
    """id, host, path, rule, vocabulary (verdict of the terms) and verdict of every page."""
    host, path = split_url(F.col("__url"))
    d = pages.select(F.col(id_col), F.col(url_col).alias("__url"))
    d = d.select(id_col, host.alias("host"), path.alias("path"), vocabulary_verdict(F.col("__url"), **vocabulary).alias("vocabulary"))
    name, verdict = path_rule(F.col("host"), F.col("path"), rules)
    return d.withColumn("rule", name).withColumn("verdict", F.coalesce(verdict, F.col("vocabulary")))

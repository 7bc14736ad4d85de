"""URL filter: host rules first, then a weighted vocabulary found by Aho-Corasick."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "page_id bigint, host string, path string, rule string, verdict string, "
    "n_strict bigint, n_soft bigint"
)
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class UrlVocabulary:
    """Terms in lower case.  One strict term rejects, or ``soft_limit`` different soft ones.

    A term counts where neither neighbour is an ASCII letter or digit.
    """

    strict: tuple[str, ...] = ("adult", "casino", "porn", "sex", "viagra", "xxx")
    soft: tuple[str, ...] = (
        "ads", "bet", "bets", "bonus", "cheap", "clicks", "deals", "escort", "farm", "free",
        "jackpot", "loan", "loans", "lottery", "pills", "poker", "replica", "spam", "track",
        "win",
    )
    soft_limit: int = 2


#: Stems by language, chosen for this engine and taken from no published list.  The strict
#: ones also count with a plural s.  Words that are plain in another of the languages are left out.
STRICT_STEMS = {
    "en": ("casino", "porn", "sexcam", "camgirl", "milf", "sportsbook", "freebet", "viagra", "cialis"),
    "es": ("porno", "sexo", "prostituta", "tragaperra", "apuesta"),
    "fr": ("sexe", "pornographie", "prostituee"),
    "de": ("gluecksspiel", "spielautomat", "sexkontakt", "erotik"),
    "it": ("pornografia", "scommesse"),
    "pt": ("putaria", "aposta"),
}
SOFT_STEMS = {
    "en": ("betting", "gambling", "slots", "roulette", "blackjack", "payday", "forex", "cheapest",
           "giveaway", "jackpots", "escorts", "erotic", "nude", "pharmacy", "pill"),
    "es": ("gratis", "barato", "baratos", "premio", "premios", "loteria", "ganar"),
    "fr": ("gratuit", "gratuits", "loterie", "rencontres", "gagner", "pari", "paris-sportifs"),
    "de": ("gratis", "kostenlos", "lotterie", "wetten", "gewinnspiel", "billig", "kredit"),
    "it": ("gratis", "lotteria", "vincere"),
    "pt": ("gratis", "loteria", "ganhar"),
}


def wide_vocabulary() -> UrlVocabulary:
    """The default terms and those of ``STRICT_STEMS`` and ``SOFT_STEMS``: about a hundred."""
    stems = {stem for words in STRICT_STEMS.values() for stem in words}
    forms = stems | {stem + "s" for stem in stems if not stem.endswith("s")}
    soft = {stem for words in SOFT_STEMS.values() for stem in words}
    base = UrlVocabulary()
    strict = tuple(sorted(forms.union(base.strict)))
    return UrlVocabulary(strict, tuple(sorted(soft.union(base.soft))), base.soft_limit)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def rule(verdict: str, place: str) -> Rule:
    """A rule from text like ``example.com/en/``."""
    host, slash, path = place.partition("/")
    return Rule(verdict, host, slash + path)


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    rest = rest.partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def matching_rule(
    host: str, path: str, by_host: dict[str, list[Rule]], longest: int
) -> Rule | None:
    """The longest rule that fits; of equal length the one with the longer host.

    ``longest`` is the length of the longest host in ``by_host``.
    """
    best = None
    if len(host) > longest:  # no rule fits a longer part
        host = host[-longest - 1 :].partition(".")[2]
    while host:
        for r in by_host.get(host, ()):
            if path.startswith(r.path) and (best is None or len(r.name) > len(best.name)):
                best = r
        host = host.partition(".")[2]
    return best


@lru_cache(maxsize=8)
def _automaton(vocabulary: UrlVocabulary) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, terms in (("soft", vocabulary.soft), ("strict", vocabulary.strict)):
        for term in terms:
            automaton.add_word(term, (kind, term))
    if len(automaton):
        automaton.make_automaton()
    return automaton


def _inner(char: str) -> bool:
    return char.isascii() and char.isalnum()


def count_terms(url: str, vocabulary: UrlVocabulary) -> tuple[int, int]:
    """How many strict terms the url has, and how many different soft ones."""
    automaton = _automaton(vocabulary)
    if not len(automaton):
        return 0, 0
    url = url.translate(_LOWER)
    strict, soft = 0, set()
    for last, (kind, term) in automaton.iter(url):
        first = last - len(term) + 1
        if first and _inner(url[first - 1]) or last + 1 < len(url) and _inner(url[last + 1]):
            continue
        if kind == "strict":
            strict += 1
        else:
            soft.add(term)
    return strict, len(soft)


def judge_urls(
    pages: DataFrame, rules: tuple[Rule, ...] = (), vocabulary: UrlVocabulary = UrlVocabulary()
) -> DataFrame:
    """One row per page: its host, path, rule, verdict and term counts.

    A fitting rule decides, else the vocabulary does.  A null url has an empty host
    and path and is allowed.  Repeated rows are judged each, a null page_id stays
    null, other columns are not read, an empty table gives no rows.
    """
    by_host: dict[str, list[Rule]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append(r)
    longest = max(map(len, by_host), default=0)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for url in batch.column("url").to_pylist():
                host, path = split_url(url)
                fit = matching_rule(host, path, by_host, longest)
                strict, soft = count_terms(url or "", vocabulary)
                rejected = strict > 0 or soft >= vocabulary.soft_limit
                verdict = fit.verdict if fit else "block" if rejected else "allow"
                rows.append((host, path, fit and fit.name, verdict, strict, soft))
            columns = zip(*rows) if rows else [()] * 6
            kinds = [pa.string()] * 4 + [pa.int64()] * 2
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            names = ["page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft"]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), *arrays], names)

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).mapInArrow(
        judge, SCHEMA
    )

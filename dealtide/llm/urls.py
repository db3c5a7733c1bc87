"""URL filters: rules by host and path, then a weighted vocabulary of URL words."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealtide.llm.tables import prepare_python

# One of the strict terms rejects a URL. Soft terms have weights, and reject it when
# the different ones in it weigh REJECT together.
STRICT = (
    "adult", "bukkake", "camgirl", "camgirls", "casino", "casinos", "cialis", "escort", "escorts",
    "fetish", "gangbang", "hardcore", "hentai", "hookup", "jackpot", "milf", "nude", "nudes", "porn",
    "porno", "pornstar", "slots", "stripclub", "viagra", "warez", "webcamsex", "xxx",
)
SOFT = {
    "ads": 1.0, "affiliate": 1.0, "babes": 1.0, "bet": 1.0, "bets": 1.0, "betting": 1.0, "bonus": 0.5,
    "cash": 0.5, "cheap": 1.0, "click": 0.5, "clicks": 1.0, "coupon": 0.5, "crack": 1.0, "dating": 1.0,
    "discount": 0.5, "download": 0.5, "farm": 1.0, "free": 1.0, "gamble": 1.0, "girls": 0.5, "hot": 0.5,
    "keygen": 1.0, "loan": 1.0, "loans": 1.0, "lottery": 1.0, "meds": 1.0, "mp3": 0.5, "offer": 0.5,
    "pharmacy": 1.0, "pill": 1.0, "pills": 1.0, "poker": 1.0, "popup": 1.0, "promo": 0.5, "replica": 1.0,
    "seo": 1.0, "serial": 0.5, "sex": 1.0, "sexy": 1.0, "spam": 1.0, "torrent": 1.0, "track": 1.0,
    "tracker": 1.0, "tracking": 0.5, "win": 0.5, "winner": 1.0,
}
REJECT = 2.0


def ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


@lru_cache(maxsize=8)
def _automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for term in soft:
        found.add_word(term, (False, term))
    for term in strict:
        found.add_word(term, (True, term))
    if len(found):
        found.make_automaton()
    return found


def _letter(char: str) -> bool:
    return "a" <= char <= "z"


def terms_in(url: str | None, strict: tuple[str, ...], soft: tuple[str, ...]) -> tuple[list, list]:
    """The different strict and soft terms in a URL in lower case, each bounded by no letter."""
    hits: tuple[set, set] = (set(), set())
    automaton = _automaton(strict, soft)
    if url and len(automaton):
        for end, (is_strict, term) in automaton.iter(url):
            begin = end + 1 - len(term)
            before, after = url[begin - 1 : begin] if begin else "", url[end + 1 : end + 2]
            if not _letter(before) and not _letter(after):
                hits[0 if is_strict else 1].add(term)
    return sorted(hits[0]), sorted(hits[1])


def judge(
    df: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = (),
    strict: Sequence[str] = STRICT,
    soft: dict[str, float] = SOFT,
    reject: float = REJECT,
) -> DataFrame:
    """All rows and columns, with host, path, rule, strict, soft (the terms found) and verdict.

    ``rules``: (verdict, host, path). A rule fits its host and all hosts below it if the path starts
    with the rule's; of those that fit, the longest decides (of equal ones, the first). Without a
    rule, the vocabulary does, over the whole URL in lower case.

    A NULL or empty URL, or one without ``://``, has an empty host and path; a NULL or empty one has
    no terms and is allowed. Columns of the names added are replaced. Rows are independent: repeated
    ones get the same verdict, an empty table gives an empty table.
    """
    added = ("host", "path", "rule", "strict", "soft", "verdict")
    prepare_python(df.sparkSession)
    strict, names = tuple(strict), tuple(soft)
    kind = pa.struct([("strict", pa.list_(pa.string())), ("soft", pa.list_(pa.string()))])

    @F.arrow_udf("strict array<string>, soft array<string>")
    def terms(urls: pa.Array) -> pa.Array:
        found = [terms_in(u, strict, names) for u in urls.to_pylist()]
        return pa.array([{"strict": a, "soft": b} for a, b in found], kind)

    given = F.col(f"`{url}`").cast("string")
    host = F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract("url", r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    ruled = F.lit(None).cast("struct<rule:string,verdict:string>")
    # The last of these decides: the longest, and of equally long ones the first that was given.
    for verdict, at, start in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = ((F.col("host") == at) | F.endswith("host", F.lit("." + at))) & F.startswith("path", F.lit(start))
        ruled = F.when(fits, F.struct(F.lit(at + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(ruled)
    weights = F.create_map(*[F.lit(x) for pair in soft.items() for x in pair]) if soft else None
    weight = F.lit(0.0) if weights is None else F.aggregate(
        "terms.soft", F.lit(0.0), lambda total, term: total + weights[term]
    )
    rejected = (F.size("terms.strict") > 0) | (weight >= F.lit(float(reject)))
    return (
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in added]).alias("row"),
            given.alias("url"),
        )
        .withColumn("host", ascii_lower(F.coalesce(host, F.lit(""))))
        .withColumn("path", F.coalesce(path, F.lit("")))
        .withColumn("ruled", ruled)
        .withColumn("terms", terms(ascii_lower(F.col("url"))))
        .select(
            "row.*", "host", "path", F.col("ruled.rule").alias("rule"), "terms.strict", "terms.soft",
            F.coalesce("ruled.verdict", F.when(rejected, "block").otherwise("allow")).alias("verdict"),
        )
    )

"""URL filter: longest host/path rule, else a weighted vocabulary found by Aho-Corasick.

The vocabulary's terms are matched in the lower-cased url; a match counts only
where the characters beside it are no ASCII letters or digits. A strict term
has the weight of a rejection by itself; several distinct soft terms are needed
for the same weight. The automaton is of fixed size (the vocabulary is a
parameter of the code, not of the data). Narrow: one pass over urls, no shuffle;
the html column is never read.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import map_texts

#: (verdict, host, path). Fixed values.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Terms of the vocabulary, by topic. Fixed values of this library. A strict term has hardly a harmless meaning in a url;
#: a soft one has, so one alone says nothing.
STRICT = tuple("""
porn porno pornhub pornstar pornstars xxx xnxx hentai milf camgirl camgirls sexcam sexcams livesex sex-chat adult-x adultfriend escort-girls
casino-win online-casino casino-bonus free-spins slot-online slots-online sportsbook betting-tips poker-online togel judi
cheap-pills viagra cialis levitra tramadol xanax-online buy-pills no-prescription
spam-farm link-farm linkfarm doorway-page backlinks-cheap buy-backlinks clickbait-farm
malware phishing ransomware keylogger botnet trojan-download exploit-kit carding cvv-shop
warez keygen keygens serialz nulled cracked-apk torrent-cracks
get-rich-quick payday-loan payday-loans work-from-home-cash double-your-bitcoin crypto-giveaway
replica-watches fake-passport fake-id essay-mill
""".split())
SOFT = tuple("""
adult sex sexy nude nudes naked erotic escort escorts fetish webcam cams dating hookup hookups singles amateur
bet bets betting bookmaker casino casinos gamble gambling jackpot lottery poker roulette slot slots spin spins wager win winner
pills pill pharmacy pharma diet slimming steroids weightloss meds
ads ad adserver adclick affiliate banner bonus click clicks coupon coupons deal deals discount popup popunder promo prize prizes redirect
sweepstakes track tracker tracking
cheap free giveaway cash earn loan loans credit debt forex bitcoin crypto airdrop investment profit rich mlm
crack cracks cracked serial torrent torrents hack hacks cheat cheats apk mod download downloads proxy unblocked
farm spam spammer seo backlink backlinks replica
""".split())
REJECT = 2
WEIGHTS = {**{t: 1 for t in SOFT}, **{t: REJECT for t in STRICT}}

RES = T.StructType([T.StructField("weight", T.LongType()), T.StructField("terms", T.ArrayType(T.StringType()))])
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _counter(weights: dict[str, int]):
    auto = ahocorasick.Automaton()
    for t in weights:
        auto.add_word(t, t)
    if weights:
        auto.make_automaton()

    def count(urls: list[bytes | None]) -> list[pa.Array]:
        total, terms = [], []
        for url in urls:
            low, found = (url or b"").translate(_LOWER), set()
            if weights:
                for end, t in auto.iter(low.decode("latin-1")):
                    begin = end + 1 - len(t)
                    if (begin == 0 or low[begin - 1] not in _ALNUM) and (end + 1 == len(low) or low[end + 1] not in _ALNUM):
                        found.add(t)
            total.append(sum(weights[t] for t in found))
            terms.append(sorted(found))
        return [pa.array(total, pa.int64()), pa.array(terms, pa.list_(pa.string()))]

    return count


def _rule(host: Column, path: Column, rules) -> Column:
    """The longest fitting rule as struct (rule, verdict), null if none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), r[1], r[2]))
    out = None
    for verdict, h, p in ordered:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def filter_urls(pages: DataFrame, keep: list[str], url_col: str = "url", rules=RULES, weights=None, reject: int = REJECT) -> DataFrame:
    """Struct ``row`` of the kept columns, then host, path, rule, verdict, weight and terms.

    A null url, or one without ``://``, has an empty host and path, fits no rule
    and is judged by its terms (null: none, allowed). Repeated rows stay.
    """
    weights = WEIGHTS if weights is None else weights
    cols = list(dict.fromkeys([*keep, url_col]))
    r = map_texts(pages, url_col, cols, lambda: _counter(weights), RES)
    url = F.coalesce(F.col("row").getField(url_col), F.lit(""))
    rest = F.regexp_extract(url, r"^(?s).*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    r = r.select(
        F.struct(*[F.col("row").getField(c).alias(c) for c in keep]).alias("row"),
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"),
        F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1).alias("path"),
        F.col("res.weight").alias("weight"), F.col("res.terms").alias("terms"))
    fit = _rule(F.col("host"), F.col("path"), rules)
    return r.withColumn("fit", fit).select(
        "row", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.when(F.col("weight") >= reject, "block").otherwise("allow")).alias("verdict"),
        "weight", "terms")

"""Personal data by weak supervision, in DataFrame and SQL functions only.

Base kinds are regexes whose matches stay as they are. A wider set of candidates
(the base regexes' matches, valid or not, and names, social security numbers,
IBANs and birth dates) is voted on by three labelers, each 1, 0 or abstaining:
the kind's strict form, a gazetteer (first names, titles, countries, card and
phone prefixes, mail domains), and words in the text before the candidate.

Expectation-maximisation over the counts of vote patterns, at most 27, gives the
labelers' reliabilities and each pattern's posterior. With these as soft labels
the final span classifier is trained: log-odds of the candidate's kind, form,
length and the word before it, from smoothed soft counts. Candidates of the
kinds beyond the base that it finds likely, and that overlap no base span, are
added.

Positions: ``split`` and ``regexp_extract_all`` of the same pattern give gaps and
matches in turn, so the running sum of their lengths places each match in code
points. The patterns use possessive repeats and start only where a run starts,
so no text makes them recurse deeply or go over a run again and again.

The texts are read once: candidates with their votes are written, a row for each
document, and training and adding read that. What reaches the driver is the
pattern counts and the classifier's weights, both of a fixed number.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import col, materialise

#: Base kinds, in the order listed. Fixed values, written so that matching is linear.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
IP_OK = rf"^{OCTET}(?:\.{OCTET}){{3}}$"

#: Gazetteers and context words of this library. Fixed values.
FIRST_NAMES = ("Alice", "Anna", "Antonio", "Carlos", "Carmen", "Charles", "Claire", "David", "Elena", "Emma", "Hans",
               "Ines", "James", "Jean", "John", "Jose", "Julia", "Karl", "Laura", "Linda", "Lucia", "Maria", "Marie",
               "Mary", "Michael", "Miguel", "Paul", "Peter", "Pierre", "Robert", "Sarah", "Sophie", "Thomas", "William")
TITLES = ("Dr", "Frau", "Herr", "Madame", "Miss", "Monsieur", "Mr", "Mrs", "Ms", "Prof")
COUNTRIES = ("AT", "BE", "CH", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE")
CONTEXT = {
    "email": "mail|contact|write|correo|kontakt|courriel",
    "ip": "ip|server|host|address|adresse|from",
    "card": "card|visa|credit|payment|karte|tarjeta|carte",
    "phone": "phone|call|tel|mobile|fax|telefon|anruf",
    "name": "name|contact|signed|author|dear|sincerely|nombre|nom",
    "ssn": "ssn|social|security|taxpayer",
    "iban": "iban|account|bank|transfer|konto|cuenta|compte",
    "birth": "born|birth|dob|geboren|nacido|nacida|naissance",
}
AGAINST = "version|release|section|chapter|isbn|order|article|figure|page|line"

NAMES, TITLE = "|".join(FIRST_NAMES), "|".join(TITLES)
EXTRA = (
    ("name", rf"(?<![\p{{L}}])(?:(?:{TITLE})\.?\x20\p{{Lu}}\p{{L}}++|(?:{NAMES})\x20\p{{Lu}}\p{{L}}++)"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("birth", r"(?<![0-9./-])[0-9]{1,2}([./-])[0-9]{1,2}\1(?:19|20)[0-9]{2}(?![0-9./-])"),
)
KINDS = tuple(k for k, _ in BASE + EXTRA)

ROUNDS = 30
THRESHOLD = 0.9
WORD_BUCKETS = 256


def _found(text: str, kind: int, pattern: str, needs: Column | None) -> Column:
    """SQL: matches of ``pattern`` as array of (start, kind, match)."""
    lit = "r'" + pattern.replace("'", r"\x27") + "'"
    m = f"regexp_extract_all({text}, {lit}, 0)"
    return F.when(needs, F.expr(m)).otherwise(F.array().cast("array<string>")) if needs is not None else F.expr(m)


def _placed(text: str, kind: int, pattern: str, matches: str) -> Column:
    lit = "r'" + pattern.replace("'", r"\x27") + "'"
    fold = f"""
      aggregate(zip_with({matches}, slice(split({text}, {lit}, -1), 1, size({matches})), (m, g) -> named_struct('m', m, 'g', g)),
        named_struct('at', 0, 'out', cast(array() as array<struct<start:int,kind:int,m:string>>)),
        (a, x) -> named_struct('at', a.at + length(x.g) + length(x.m),
          'out', concat(a.out, array(named_struct('start', a.at + length(x.g), 'kind', {kind}, 'm', x.m)))),
        a -> a.out)"""
    none = "cast(array() as array<struct<start:int,kind:int,m:string>>)"
    return F.expr(f"if(size({matches}) > 0, {fold}, {none})")


LUHN = """aggregate(
    transform(split(reverse(regexp_replace(x.m, '[^0-9]', '')), ''), (d, i) ->
      if(i % 2 = 0, int(d), if(int(d) > 4, 2 * int(d) - 9, 2 * int(d)))), 0, (a, d) -> a + coalesce(d, 0)) % 10 = 0"""
DIGITS = "length(regexp_replace(x.m, '[^0-9]', ''))"


def _valid() -> str:
    """SQL of (x.kind, x.m): whether a match has its kind's strict form."""
    return f"""case x.kind
      when 0 then true
      when 1 then x.m rlike r'{IP_OK}'
      when 2 then {DIGITS} between 12 and 19 and {LUHN}
      when 3 then {DIGITS} between 9 and 15
      when 4 then length(x.m) >= 6
      when 5 then not x.m rlike '^(000|666|9)|-00-|-0000$'
      when 6 then length(replace(x.m, ' ', '')) between 15 and 34
      else cast(regexp_extract(x.m, r'^([0-9]+)', 1) as int) between 1 and 31 end"""


def _gazetteer() -> str:
    """SQL of the gazetteer's vote: 1, 0 or -1 (abstains)."""
    names, countries = f"^({NAMES})|^({TITLE})[. ]", "|".join(COUNTRIES)
    return f"""case x.kind
      when 0 then if(lower(x.m) rlike r'\\.(com|org|net|edu|gov|info|de|fr|es|uk|io)$', 1, -1)
      when 1 then if(x.m rlike r'^(0|10|127|255)\\.|^(192\\.168|0\\.0)\\.', 0, -1)
      when 2 then if(x.m rlike '^(4|5[1-5]|34|37|6011|65)', 1, 0)
      when 3 then if(x.m rlike r'^\\+(1|3[0-9]|4[0-9]|5[1-8]|6[0-6]|7|8[1-6]|9[0-8])', 1, 0)
      when 4 then if(x.m rlike r'{names}', 1, 0)
      when 6 then if(x.m rlike '^({countries})', 1, 0)
      else -1 end"""


def _context() -> str:
    words = "case x.kind " + " ".join(
        f"when {k} then r'(?i)\\b({CONTEXT[name]})'" for k, name in enumerate(KINDS)) + " end"
    return f"if(before rlike {words}, 1, if(before rlike r'(?i)\\b({AGAINST})\\b', 0, -1))"


def candidates(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Struct ``row`` of the kept columns; ``base`` spans and ``cands`` with votes and features."""
    text = F.coalesce(col(text_col), F.lit(""))
    df = docs.select(F.struct(*[col(c) for c in keep]).alias("row"), text.alias("t"))
    # a contains() is much cheaper than a regex where most texts have no match
    needs = {"email": F.col("t").contains("@"), "ip": None, "card": None, "phone": F.col("t").contains("+"),
             "name": None, "ssn": None, "iban": None, "birth": None}
    both = BASE + EXTRA
    df = df.select("row", "t", *[_found("t", k, p, needs[n]).alias(f"m{k}") for k, (n, p) in enumerate(both)])
    df = df.select("row", "t", *[_placed("t", k, p, f"m{k}").alias(f"p{k}") for k, (_, p) in enumerate(both)])
    df = df.select("row", "t", F.array_sort(F.flatten(F.array(*[F.col(f"p{k}") for k in range(len(both))]))).alias("all"))
    said = f"""transform(all, x -> named_struct(
        'start', x.start, 'end', x.start + length(x.m), 'kind', x.kind, 'ok', coalesce({_valid()}, false),
        'm', x.m, 'before', substring(t, greatest(x.start - 39, 1), least(x.start, 40))))"""
    df = df.select("row", F.expr(said).alias("all"))
    votes = f"""transform(all, x -> named_struct(
        'start', x.start, 'end', x.end, 'kind', x.kind, 'ok', x.ok,
        'votes', named_struct('form', if(x.ok, 1, 0), 'gazetteer', {_gazetteer()}, 'context', {_context().replace('before', 'x.before')}),
        'features', array(
          concat('kind ', x.kind, ' ', if(x.ok, 1, 0)),
          concat('gazetteer ', x.kind, ' ', {_gazetteer()}),
          concat('length ', x.kind, ' ', least(length(x.m), 40) div 4),
          concat('word ', pmod(xxhash64(lower(regexp_extract(x.before, r'([\\p{{L}}]+)[^\\p{{L}}]*$', 1))), {WORD_BUCKETS})))))"""
    return df.select(
        "row", F.expr(f"filter(all, x -> x.kind < {len(BASE)} and x.ok)").alias("base"), F.expr(votes).alias("cands")
    ).select("row", F.expr("transform(base, x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end))").alias("base"), "cands")


def reliabilities(patterns: dict[tuple[int, ...], int]) -> tuple[float, list[list[dict[int, float]]], dict[tuple[int, ...], float]]:
    """(prior, per labeler and class the chance of each vote, posterior of each pattern) by EM.

    Works on the counts of the at most 27 patterns. Starts from the majority of
    the votes; abstaining is evidence of neither class.
    """
    n_labelers = len(next(iter(patterns))) if patterns else 0
    post = {p: 0.5 + 0.4 * (sum(1 if v == 1 else -1 if v == 0 else 0 for v in p) / max(1, n_labelers)) for p in patterns}
    prior, chance = 0.5, []
    for _ in range(ROUNDS):
        total = sum(patterns.values())
        prior = min(0.99, max(0.01, (1 + sum(n * post[p] for p, n in patterns.items())) / (2 + total)))
        chance = []
        for k in range(n_labelers):
            per_class = []
            for c in (0, 1):
                counts = {v: 1.0 + (2.0 if v == c else 0.0) for v in (0, 1)}  # a labeler is right more often than not
                for p, n in patterns.items():
                    if p[k] >= 0:
                        counts[p[k]] += n * (post[p] if c else 1 - post[p])
                per_class.append({v: x / sum(counts.values()) for v, x in counts.items()})
            chance.append(per_class)
        for p in patterns:
            a, b = math.log(prior), math.log(1 - prior)
            for k, v in enumerate(p):
                if v >= 0:
                    a += math.log(chance[k][1][v])
                    b += math.log(chance[k][0][v])
            post[p] = 1 / (1 + math.exp(min(700, b - a)))
    return prior, chance, post


def train(found: DataFrame) -> tuple[float, dict[str, float]]:
    """(log-odds of the prior, log-odds of each feature) of the span classifier."""
    spans = found.select(F.explode("cands").alias("c")).select("c.votes", "c.features")
    counts = spans.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = {tuple(r.votes): r.n for r in counts}
    if not patterns:
        return 0.0, {}
    prior, _, post = reliabilities(patterns)
    p = F.coalesce(*[
        F.when((F.col("votes.form") == k[0]) & (F.col("votes.gazetteer") == k[1]) & (F.col("votes.context") == k[2]), F.lit(v))
        for k, v in sorted(post.items())], F.lit(0.5))
    soft = spans.select(F.explode("features").alias("f"), p.alias("p")).groupBy("f").agg(
        F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
    base = math.log(prior / (1 - prior))
    weights = {r.f: math.log((r.yes + 1) / (r.no + 1)) - base for r in soft.collect()}
    return base, weights


def find(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """Struct ``row`` of the kept columns; ``base`` and ``spans`` (start, kind number, end) by start, then kind.

    Null and empty texts have no spans; repeated rows stay; without any candidate
    nothing is trained and nothing added. Ends are exclusive, places code points.
    """
    found = materialise(candidates(docs, keep, text_col), "pii-candidates")
    base, weights = train(found)
    if weights:
        table = F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv])
        score = lambda c: F.aggregate(
            c["features"], F.lit(base), lambda a, f: a + F.coalesce(table[f], F.lit(0.0)))
    else:
        score = lambda c: F.lit(base)
    likely = F.filter("cands", lambda c: (c["kind"] >= len(BASE)) & c["ok"] & (score(c) >= math.log(THRESHOLD / (1 - THRESHOLD)))
                      & ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    added = F.transform(likely, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return found.select("row", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def _said(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), *[count(k).alias(f"n_{n}") for k, (n, _) in enumerate(BASE)],
        F.sha2(_said("base"), 256).alias("base_sha256"), _said("spans").alias("spans"))


def redacted(found: DataFrame, text_col: str = "text") -> Column:
    """The text of ``row`` with each span, or run of spans that overlap, replaced by its first kind in angle brackets."""
    names = "array(" + ", ".join(f"'<{k.upper()}>'" for k in KINDS) + ")"
    t = f"row.`{text_col}`"
    return F.expr(f"""if(size(spans) = 0, {t}, aggregate(spans, named_struct('at', 0, 'out', ''),
        (a, x) -> if(x.start < a.at, named_struct('at', greatest(a.at, x.end), 'out', a.out),
          named_struct('at', x.end, 'out', concat(a.out, substring({t}, a.at + 1, x.start - a.at), element_at({names}, x.kind + 1)))),
        a -> concat(a.out, substring({t}, a.at + 1))))""")

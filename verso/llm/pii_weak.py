"""Personal data by weak supervision, with DataFrame functions only.

Base spans are the validated matches of four patterns (email, ip, card, phone); they
always stay. Further candidates are matches that fail validation, looser written
forms (``name (at) host``, ``10[.]1[.]2[.]3``, ``4111.1111.1111.1111``,
``555-123-4567``), titled names, and secrets: unbroken runs of 16 or more letters,
digits and ``+/_-`` that hold both a letter and a digit. Four labelers vote on every
span, for (1), against (-1) or not at all (0):

* pattern: a validated match or a key's known beginning; a failed match, or a word with
  a short number;
* gazetteer: known domains, calling codes, issuer digits, private networks, given names,
  names of credentials and of digests just before a value;
* context: cue words within ``NEAR`` characters on either side; for a secret, that it
  is assigned or quoted, or part of a path;
* edges: a span that stands alone, or goes on into another word or number.

The votes of all spans are counted by kind and pattern of votes (at most kinds x 3^4
rows go to the driver, whatever the input). Expectation-maximisation over those counts
estimates each labeler's reliability (one for all kinds), each kind's rate and every
pattern's probability. The same counts,
split by span features, train the final classifier (naive Bayes on the probabilities:
length, digits, neighbours, cue, form, gazetteer). Candidates of probability ``threshold`` or more join
the base spans; one that touches a base span is left out.

Positions are code points. They come from the text between matches, so a text is cut
once for each pattern that occurs in it. Patterns are written so that a run of
characters is tried once. Running sums are made in blocks of ``BLOCK`` matches, so a
very long text takes work in proportion to its matches (times ``BLOCK``).

Cases: null text is empty. Null ids and repeated rows keep their rows. Without any span
the reliabilities stay at their priors. Other columns are ignored (``redact`` keeps
them); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verso.llm.common import materialize

KINDS = ["email", "ip", "card", "phone", "name", "secret"]
BASE = KINDS[:4]
THRESHOLD = 0.9
ROUNDS = 50
NEAR = 30  # characters before and after a span in which a cue counts
BLOCK = 64  # matches of one running sum

# The contract's patterns. Lookbehinds and possessive quantifiers only spare attempts
# that must fail: inside a run of local-part characters every start meets the same @
# (\\G: right after the last match a run may go on), and a run of digits likewise.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\))[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9A-Za-z.])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "name": r"(?<!\p{L})(?:Mrs|Mr|Ms|Dr|Herr|Frau|Mme|Señora|Señor)\.? \p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++)?+",
    "secret": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])(?=[0-9+/_-]*+[A-Za-z])[A-Za-z0-9+/_-]{16,}+",
}
# A text without this holds no match: cheaper to look for than the pattern.
NEEDS = {("email", True): ["@"], ("phone", True): ["+"], ("email", False): ["(at)", "[at]"]}

# Gazetteers and cues.
TOP_DOMAINS = "com org net edu gov info io de fr es uk eu example".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 52 54 55 56 57 61 62 63 64 65 66 81 82 84 86 90 91".split()
GIVEN_NAMES = (
    "Alice Amy Andrew Anthony Barbara Brian Charles Daniel David Donald Elizabeth Emily Emma George Helen James Jennifer John Joseph Karen Kevin Laura Linda Lisa "
    "Margaret Mark Mary Matthew Michael Nancy Patricia Paul Richard Robert Sarah Susan Thomas William "
    "Andreas Anna Birgit Christian Claudia Hans Heike Jürgen Julia Karl Katrin Klaus Monika Peter Sabine Stefan Ursula Wolfgang "
    "André Camille Catherine Claire François Isabelle Jacques Jean Louis Marie Michel Nicolas Philippe Pierre Sophie "
    "Alejandro Ana Antonio Carlos Carmen Elena Francisco Javier José Juan Lucía Luis Manuel María Maria Miguel Pablo Pedro"
).split()
CREDENTIALS = "token secret password passwd pwd passphrase api[_ -]?key access[_ -]?key private[_ -]?key secret[_ -]?key auth[_ -]?key bearer credential".split()
DIGESTS = "sha sha-?1 sha-?256 md5 commit checksum hash digest etag revision uuid guid fingerprint".split()
KEY_STARTS = "AKIA ghp_ gho_ ghs_ ghu_ glpat- sk- sk_live_ pk_live_ xoxb- xoxp- AIza".split()
CUES = {
    "email": "mail contact contacto kontakt write courriel correo",
    "ip": "ip host server address adresse",
    "card": "card visa mastercard amex karte carte tarjeta credit",
    "phone": "phone tel call mobile fax telefon téléphone teléfono",
    "name": "dear by from signed attn regards sincerely wrote writes said asked",
    "secret": "login credentials confidential",
}
AGAINST = "isbn version order invoice page figure section doi part serial tracking"
LABELERS = ["pattern", "gazetteer", "context", "edges"]
# Priors: (vote for, no vote, vote against) of a true and of a false span. To stand
# alone says little, a failed validation much.
PRIORS = {
    "pattern": ((0.6, 0.38, 0.02), (0.05, 0.35, 0.6)),
    "gazetteer": ((0.6, 0.35, 0.05), (0.15, 0.4, 0.45)),
    "context": ((0.45, 0.5, 0.05), (0.05, 0.6, 0.35)),
    "edges": ((0.9, 0.05, 0.05), (0.6, 0.15, 0.25)),
}
# A labeler has one reliability for all kinds: of a kind whose spans only one labeler
# tells apart, EM by itself would take all for one class. Priors weigh as much as
# ``PRIOR_WEIGHT`` spans and ``PRIOR_SHARE`` of all.
PRIOR_WEIGHT, PRIOR_SHARE, PRIOR_RATE = 10.0, 0.2, 0.5


# --- spans ----------------------------------------------------------------------

_EMPTY = "cast(array() as array<struct<start:int,stop:int,kind:string,base:boolean,ok:boolean,said:string,left:string,right:string>>)"


def _valid(kind: str, said: Column) -> Column:
    digits = F.regexp_replace(said, "[^0-9]", "")
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(said, r"[\[(]?\.[\])]?"), lambda p: (F.length(part(p)) < 3) | ((F.length(part(p)) == 3) & (part(p) <= "255")))
    if kind == "card":
        figures = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
        twice = lambda c, i: c.cast("int") * (1 + i % 2)
        total = F.aggregate(F.transform(figures, lambda c, i: F.when(twice(c, i) > 9, twice(c, i) - 9).otherwise(twice(c, i))), F.lit(0), lambda a, x: a + x)
        return F.length(digits).between(14, 19) & (total % 10 == 0)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sums(values: Column) -> Column:
    """Inclusive running sums of an array of integers; quadratic in its length."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
    return F.aggregate(values, start, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out")), lambda acc: acc["out"])


def _running(values: Column) -> Column:
    """Inclusive running sums of a non-empty array, block by block."""

    def joined(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
        before = _let(totals, lambda t: F.zip_with(_sums(t), t, lambda upto, own: upto - own))
        return F.flatten(F.zip_with(F.transform(blocks, _sums), before, lambda block, at: F.transform(block, lambda x: x + at)))

    cut = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))
    return _let(values, lambda v: _let(cut(v), joined))


def _matches(text: str, kind: str, base: bool) -> Column:
    """All matches of one pattern with their positions and neighbourhood."""
    pattern = (PATTERNS if base else LOOSE)[kind]
    pieces, said = F.split(F.col(text), pattern, -1), F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    rows = F.arrays_zip(said.alias("said"), pieces.alias("gap"), F.slice(pieces, F.lit(2), F.size(pieces)).alias("after"))
    rows = F.filter(rows, lambda r: r["said"].isNotNull())

    def span(r: Column, stop: Column) -> Column:
        return F.struct(
            (stop - F.char_length(r["said"])).alias("start"), stop.alias("stop"), F.lit(kind).alias("kind"), F.lit(base).alias("base"),
            _valid(kind, r["said"]).alias("ok"), r["said"].alias("said"), F.right(r["gap"], F.lit(NEAR)).alias("left"), F.left(r["after"], F.lit(NEAR)).alias("right"),
        )

    found = _let(rows, lambda found: F.zip_with(found, _running(F.transform(found, lambda r: F.char_length(r["gap"]) + F.char_length(r["said"]))), span))
    there = F.col(text).rlike(pattern)
    if needs := NEEDS.get((kind, base)):
        seen = F.contains(F.col(text), F.lit(needs[0]))
        for n in needs[1:]:
            seen = seen | F.contains(F.col(text), F.lit(n))
        there = seen & there
    return F.when(there, found).otherwise(F.expr(_EMPTY))


def candidates(docs: DataFrame, rows: bool = False) -> DataFrame:
    """(doc_id, base, more): base spans in order, and the other candidates; with
    ``rows`` also the whole row as ``_row``."""
    keep = [F.struct(*docs.columns).alias("_row")] if rows else []
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"), *keep)
    for k in BASE:
        texts = texts.withColumn(f"_{k}", _matches("_text", k, True))
    for k in LOOSE:
        texts = texts.withColumn(f"_loose_{k}", _matches("_text", k, False))
    strict = F.concat(*(f"_{k}" for k in BASE))
    texts = texts.withColumn("base", _in_order(F.filter(strict, lambda s: s["ok"])))
    more = F.concat(F.filter(strict, lambda s: ~s["ok"]), *(f"_loose_{k}" for k in LOOSE))
    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))
    return texts.withColumn("more", F.filter(more, free)).select("doc_id", *["_row"][: len(keep)], "base", "more")


def _place(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def _in_order(items: Column, span: Callable[[Column], Column] = lambda x: x) -> Column:
    """Sorted by start, then kind as listed, then end of each one's span."""
    keyed = F.transform(items, lambda x: F.struct(span(x)["start"].alias("start"), _place(span(x)["kind"]).alias("place"), span(x)["stop"].alias("stop"), x.alias("x")))
    return F.transform(F.sort_array(keyed), lambda k: k["x"])


# --- labelers and features --------------------------------------------------------


def _any(words: str) -> str:
    return r"(?i)(?<!\p{L})(?:" + "|".join(words.split()) + r")(?!\p{L})"


def _among(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


_SIGN = r"[\"']?\s{0,3}(?:[=:]|=>|is)?\s{0,3}[\"']?$"  # between a name and its value


def _cue(s: Column) -> Column:
    out = F.lit(0)
    for k, words in CUES.items():
        said = s["left"].rlike(_any(words)) | s["right"].rlike(_any(words))
        if k == "secret":
            said = said | s["left"].rlike(r"[=:]\s{0,3}[\"']?$") | (s["left"].rlike(r"[\"']$") & s["right"].rlike(r"^[\"']"))
        out = F.when((s["kind"] == k) & said, 1).otherwise(out)
    path = (s["kind"] == "secret") & s["left"].rlike(r"[./#@\\]$")
    return F.when(path | s["left"].rlike(_any(AGAINST)), -1).otherwise(out)


def votes(s: Column) -> list[Column]:
    """The four labelers' votes on a span."""
    said, kind, digits = s["said"], s["kind"], F.regexp_replace(s["said"], "[^0-9]", "")
    shape = F.when(said.rlike(f"^{_among(KEY_STARTS)}"), 1).when(said.rlike(r"^[A-Za-z_/+-]+[0-9]{1,4}$") | said.rlike(r"^[0-9]{1,4}[A-Za-z_/+-]+$"), -1).otherwise(0)
    pattern = F.when(~s["ok"], -1).when(s["base"] | kind.isin("ip", "card"), 1).when(kind == "secret", shape).otherwise(0)
    gazetteer = (
        F.when(kind == "email", F.when(said.rlike(rf"(?i)[.)\] ]{_among(TOP_DOMAINS)}$"), 1).otherwise(0))
        .when(kind == "phone", F.when(said.rlike(rf"^\+{_among(CALLING_CODES)}"), 1).when(digits.rlike("^[01]"), -1).otherwise(0))
        .when(kind == "card", F.when(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), 1).otherwise(-1))
        .when(kind == "ip", F.when(said.rlike(r"^0*(?:0|127|255)[\[(.]"), -1).otherwise(1))
        .when(kind == "secret", F.when(s["left"].rlike(rf"(?i){_among(CREDENTIALS)}s?{_SIGN}"), 1).when(s["left"].rlike(rf"(?i)(?<!\p{{L}}){_among(DIGESTS)}{_SIGN}"), -1).otherwise(0))
        .otherwise(F.when(said.rlike(rf" {_among(GIVEN_NAMES)}(?!\p{{L}})"), 1).otherwise(0))
    )
    joined = r"[\p{L}\p{N}_]"
    before, after = F.right(s["left"], F.lit(1)), F.left(s["right"], F.lit(1))
    edges = F.when(before.rlike(joined) | after.rlike(joined), -1).otherwise(1)
    return [pattern, gazetteer, _cue(s), edges]


def features(s: Column) -> list[Column]:
    """Discrete features of a span, as name=value."""
    side = lambda c: F.when(c == "", "none").when(c.rlike(r"\s"), "space").when(c.rlike(r"\p{L}"), "letter").when(c.rlike(r"\p{N}"), "digit").otherwise("sign")
    n, digits = F.char_length(s["said"]), F.char_length(F.regexp_replace(s["said"], "[^0-9]", ""))
    values = {
        "length": F.least(F.floor(F.log2(n.cast("double"))), F.lit(7)), "digits": F.floor(4 * digits / n),
        "left": side(F.right(s["left"], F.lit(1))), "right": side(F.left(s["right"], F.lit(1))), "cue": _cue(s),
        "form": F.when(~s["ok"], "failed").when(s["base"], "base").otherwise("loose"), "known": votes(s)[1],
    }
    return [F.concat(s["kind"], F.lit(f":{name}="), v.cast("string")) for name, v in values.items()]


class Weights:
    """What EM and the classifier learned: rate of each kind, reliability of each
    labeler (one for all kinds), and the log odds of a kind and of its features."""

    def __init__(self, counts: dict[tuple[str, tuple[int, ...]], int], seen: dict[tuple[str, tuple[int, ...]], dict[str, int]]):
        self.rate, self.reliability, self.odds = {}, {}, {}
        posterior = self._em(counts)
        good, bad = defaultdict(float), defaultdict(float)
        for key, by_feature in seen.items():
            for name, n in by_feature.items():
                good[name] += n * posterior[key]
                bad[name] += n * (1 - posterior[key])
        total = {k: (sum(n * posterior[k, v] for (x, v), n in counts.items() if x == k), sum(n * (1 - posterior[k, v]) for (x, v), n in counts.items() if x == k)) for k in KINDS}
        for k, (a, b) in total.items():
            self.odds[k] = math.log((a + PRIOR_RATE) / (b + 1 - PRIOR_RATE))
        for name in sorted(set(good) | set(bad)):
            a, b = total[name.split(":")[0]]
            self.odds[name] = math.log((good[name] + 1) / (a + 2)) - math.log((bad[name] + 1) / (b + 2))
        self.posterior = posterior

    def _em(self, counts: dict[tuple[str, tuple[int, ...]], int]) -> dict[tuple[str, tuple[int, ...]], float]:
        index = {1: 0, 0: 1, -1: 2}
        true, false = [list(PRIORS[x][0]) for x in LABELERS], [list(PRIORS[x][1]) for x in LABELERS]
        rate, p = dict.fromkeys(KINDS, PRIOR_RATE), dict.fromkeys(counts, PRIOR_RATE)
        weight = PRIOR_WEIGHT + PRIOR_SHARE * sum(counts.values())
        for _ in range(ROUNDS):
            for kind, v in counts:
                a = math.log(rate[kind]) + sum(math.log(true[i][index[x]]) for i, x in enumerate(v))
                b = math.log(1 - rate[kind]) + sum(math.log(false[i][index[x]]) for i, x in enumerate(v))
                p[kind, v] = 1 / (1 + math.exp(min(500.0, max(-500.0, b - a))))
            for kind in KINDS:
                own = {key: n for key, n in counts.items() if key[0] == kind}
                yes = sum(n * p[key] for key, n in own.items())
                rate[kind] = min(1 - 1e-6, max(1e-6, (yes + PRIOR_WEIGHT * PRIOR_RATE) / (sum(own.values()) + PRIOR_WEIGHT)))
            for i, labeler in enumerate(LABELERS):
                for table, prior, share in ((true, PRIORS[labeler][0], p.get), (false, PRIORS[labeler][1], lambda key: 1 - p[key])):
                    got = [sum(n * share(key) for key, n in counts.items() if index[key[1][i]] == j) for j in range(3)]
                    table[i] = [(got[j] + weight * prior[j]) / (sum(got) + weight) for j in range(3)]
        self.rate, self.reliability = rate, {kind: {name: (true[i], false[i]) for i, name in enumerate(LABELERS)} for kind in KINDS}
        return p

    def probability(self, s: Column) -> Column:
        """The classifier: probability that a span is personal data."""
        table = F.create_map(*(F.lit(x) for kv in self.odds.items() for x in kv))
        total = F.try_element_at(table, s["kind"])
        for f in features(s):
            total = total + F.coalesce(F.try_element_at(table, f), F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def learn(found: DataFrame) -> Weights:
    """EM and classifier from the spans of ``candidates``. One aggregate; its rows
    number kinds x vote patterns x feature values at most."""
    spans = found.select(F.explode(F.concat("base", "more")).alias("s"))
    rows = spans.select(F.col("s.kind").alias("kind"), F.array(*votes(F.col("s"))).alias("votes"), F.explode(F.array(F.lit("all"), *features(F.col("s")))).alias("feature"))
    counts, seen = {}, defaultdict(dict)
    for r in sorted(rows.groupBy("kind", "votes", "feature").count().collect()):  # sums in one order
        key = (r.kind, tuple(r.votes))
        if r.feature == "all":
            counts[key] = r["count"]
        else:
            seen[key][r.feature] = r["count"]
    return Weights(counts, seen)


# --- results ----------------------------------------------------------------------


def accepted(found: DataFrame, weights: Weights, threshold: float = THRESHOLD) -> DataFrame:
    """Adds ``weighed``, the candidates as (s, p) with their probability, and ``spans``:
    base spans and accepted candidates in order."""
    found = found.withColumn("weighed", F.transform("more", lambda s: F.struct(s.alias("s"), weights.probability(s).alias("p"))))
    more = F.transform(F.filter("weighed", lambda x: x["p"] >= threshold), lambda x: x["s"])
    return found.withColumn("spans", _in_order(F.concat("base", more)))


def _written(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _listed(weighed: Column) -> Column:
    ordered = _in_order(weighed, lambda x: x["s"])
    said = lambda x: F.concat_ws(":", x["s"]["kind"], x["s"]["start"].cast("string"), x["s"]["stop"].cast("string"), F.format_number(x["p"], 3))
    return F.array_join(F.transform(ordered, said), ",")


def find(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: numbers of base spans, digest of the base spans, and all
    spans as kind:start:end; then how many candidates joined them, and the ``added`` and
    ``refused`` ones as kind:start:end:probability."""
    found = materialize(candidates(docs))  # spans only, no text
    weights = learn(found)
    out = accepted(found, weights, threshold)
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    yes, no = F.filter("weighed", lambda x: x["p"] >= threshold), F.filter("weighed", lambda x: x["p"] < threshold)
    return out.select(
        "doc_id", *(number(k) for k in BASE), F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans"),
        F.size(yes).cast("long").alias("n_added"), _listed(yes).alias("added"), _listed(no).alias("refused"),
    )


def redact(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in brackets; spans that
    overlap go under the first one's. Texts without spans, and nulls, stay. A column
    ``n_chars`` gets the new length."""
    weights = learn(candidates(docs))
    columns = docs.columns
    out = accepted(candidates(docs, rows=True), weights, threshold)
    text = F.col("_row.text")

    def cut(acc: Column, s: Column) -> Column:
        shown = F.concat(acc["out"], F.array(text.substr(acc["at"] + 1, s["start"] - acc["at"]), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), F.when(s["start"] >= acc["at"], shown).otherwise(acc["out"]).alias("out"))

    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), text.substr(acc["at"] + 1, F.char_length(text)))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))
    new = F.when(F.size("spans") > 0, F.aggregate("spans", start, cut, rest)).otherwise(text)
    out = out.withColumn("_new", new)
    changed = {"text": F.col("_new"), "n_chars": F.when(F.size("spans") > 0, F.char_length("_new").cast(dict(docs.dtypes).get("n_chars", "long"))).otherwise(F.col("_row.n_chars")) if "n_chars" in columns else None}
    return out.select(*(changed[c].alias(c) if changed.get(c) is not None else F.col("_row")[c].alias(c) for c in columns))

"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation
estimates how reliable each labeler is, and a span classifier is trained on the result.

Spans of four kinds with fixed definitions (email, ip, card, phone) are always reported. Looser
candidates of further kinds are reported only if the classifier accepts them. The labelers are
a strict pattern, a checksum (of secrets and long numbers: whether the characters are mixed as
chance would mix them), a gazetteer and the words in front of a span. They look at different
things, so they can disagree, and the classifier also sees the size, the digits, the case and the
place of a span, on which no labeler votes.

Texts are scanned once, in column expressions; only what the patterns match leaves a row. The
estimation needs counts per vote pattern, of which there are at most a few thousand whatever
the corpus, so its loops run over those counts."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import solid, written

#: The reported kinds, in their order within one start. The first four have fixed definitions.
KINDS = ["email", "ip", "card", "phone", "secret", "iban", "ssn", "local_phone", "account"]
BASE = KINDS[:4]
#: A cheap test before each pattern, and the pattern. Quantifiers are possessive and a run is
#: entered at its first character only, so long runs cost no more than their length.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": ("@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9](?:[\x20-]?[0-9]){11}",
             r"(?<![0-9])(?<![0-9][\x20-])(?=[0-9](?:[\x20-]?[0-9]){11})[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "secret": (r"[=:]\s{0,2}[\"']",
               r"(?i:token|secret|passwo?r?d|api_?key|auth|credential)\s{0,2}[=:]\s{0,2}"
               r"(?:\"[^\"\s]{8,}+\"|'[^'\s]{8,}+')"),
    "iban": (r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11}",
             r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])"),
    "ssn": (r"[0-9]-[0-9]{2}-[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "local_phone": (r"[0-9][\x20.-][0-9]{4}",
                    r"(?<![0-9+().-])(?<!\+[0-9]{1,3}[\x20.-]{0,2})(?:\([0-9]{3}\)\x20?|"
                    r"[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
    # a long number that is no card; whether it is one is decided by _checked()
    "account": (r"[0-9](?:[\x20-]?[0-9]){11}",
                r"(?<![0-9.+])(?<![0-9][\x20-])(?=[0-9](?:[\x20-]?[0-9]){11})[0-9](?:[\x20-]?[0-9])++(?!\.[0-9])"),
}
#: Strict forms, one for each kind.
STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,24}$",
    "ip": r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})$",
    "phone": r"^\+[0-9]{1,3}[\x20-](?:\([0-9]++\)[\x20-])?[0-9]++(?:[\x20-][0-9]++)*+$",
    "secret": r"[\"'][A-Za-z0-9+/_=.-]{16,}+[\"']$",
    "iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$",
    "ssn": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "local_phone": r"^\([2-9][0-9]{2}\)\x20?[0-9]{3}-[0-9]{4}$",
    "account": r"^(?:[0-9]{16}|[0-9]{4}(?:[\x20-][0-9]{4}){3})$",
}
#: Entries whose presence in a span speaks for its kind.
GAZETTEER = {
    "email": r"\.(?:com|org|net|edu|gov|info|io|eu|uk|us|de|fr|es|it|nl|ch|at|pl|br|ca|au|jp)$",
    "ip": r"^(?!(?:0|127|224|255)\.)",
    "card": r"^(?:4|5[1-5]|34|37|6011|62|65)",
    "phone": r"^\+(?:1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|52|55|61|81|86|91)",
    # no placeholder, and the length or prefix of a known form
    "secret": r"(?i)^(?!.*(?:example|change|your|dummy|x{4}|1234|secret[\"']$|password[\"']$)).*[\"'](?:"
              r"[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|AKIA\w{12,}|gh[a-z]_\w+|sk-\S+|eyJ\S+)[\"']$",
    "iban": r"^(?:AT|BE|BG|CH|CZ|DE|DK|ES|FI|FR|GB|GR|HU|IE|IT|LU|NL|NO|PL|PT|RO|SE|SK)",
    "ssn": "^(?!078-05-1120|219-09-9999|123-45-6789|987-65)",  # published sample numbers
    "local_phone": r"^(?!.*555.01)\(?(?:20[1-9]|21[2-9]|30[1-9]|31[0-9]|40[1-9]|41[0-9]|50[1-9]|51[0-9]|"
                   r"60[1-9]|61[0-9]|70[1-9]|71[2-9]|80[1-8]|81[0-9]|90[1-9]|91[0-9])",
    "account": r"^(?:4|5[1-5]|34|37|6011|62|65)",
}
#: Words in front of a span that speak for its kind, and words that speak against any.
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write|kontakt|correo|courriel)\W*$",
    "ip": r"(?i)(?:\bip|host|server|address|adresse)\W*$",
    "card": r"(?i)(?:card|visa|master|karte|carte|tarjeta|credit)\W*(?:no|number)?\W*$",
    "phone": r"(?i)(?:tel|phone|call|fax|mobile|telefon|tél)\w*\W*$",
    "secret": r"(?i)(?:secret|private|key|auth|export|set|config|const)\W*$",
    "iban": r"(?i)(?:iban|konto|account|cuenta|compte)\W*$",
    "ssn": r"(?i)(?:ssn|social security)\W*(?:no|number)?\W*$",
    "local_phone": r"(?i)(?:tel|phone|call|fax|mobile)\w*\W*$",
    "account": r"(?i)(?:card|visa|account|konto|carte|tarjeta|credit|cuenta|compte)\W*(?:no|number|nr)?\W*$",
}
AGAINST = r"(?i)(?:version|v\.|isbn|doi|section|chapter|figure|order|page|license)\W*$"
#: Characters kept in front of a span; probability from which a looser candidate is reported.
BEFORE, ACCEPT = 24, 0.8
ROUNDS, STEPS = 25, 200
VOTERS = ["strict", "checksum", "gazetteer", "context"]
#: What the classifier sees besides the votes: length, digits, capitals, what stands before.
SEEN = ["size", "share", "upper", "place"]


def _matches(text: Column, kind: str) -> Column:
    """array<struct> of a kind's matches: number, characters since the match before, text."""
    test, pattern = PATTERNS[kind]
    gaps = F.split(text, pattern, -1)
    rows = F.zip_with(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), gaps,
        lambda v, g: F.struct(v.alias("value"), F.length(g).alias("gap"),
                              F.substring(g, -BEFORE, BEFORE).alias("before")))
    rows = F.filter(rows, lambda x: x["value"].isNotNull())
    rows = F.transform(rows, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), x["value"].alias("value"),
        x["gap"].alias("gap"), x["before"].alias("before")))
    plain = not set(test) & set("[\\")
    return F.when(text.contains(test) if plain else text.rlike(test), rows)


def _case(values: dict[str, Column]) -> Column:
    out = None
    for kind, value in values.items():
        out = (F.when if out is None else out.when)(F.col("kind") == kind, value)
    return out


def _luhn(digits: str) -> Column:
    """Whether the digits in the named column pass the Luhn test."""
    return F.expr(
        f"aggregate(sequence(1, greatest(length({digits}), 1)), 0, (s, i) -> s + "
        f"CASE WHEN i % 2 = 1 THEN int(substr({digits}, -i, 1)) "
        f"WHEN int(substr({digits}, -i, 1)) > 4 THEN 2 * int(substr({digits}, -i, 1)) - 9 "
        f"ELSE 2 * int(substr({digits}, -i, 1)) END) % 10 = 0")


_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def _checked(spans: DataFrame) -> DataFrame:
    """Add valid (the base definition's test, true for the other kinds) and the votes."""
    v = F.col("value")
    spans = spans.withColumn("digits", F.regexp_replace(v, "[^0-9]", ""))
    n = F.length("digits")
    luhn = F.when(n.between(12, 19), _luhn("digits")).otherwise(F.lit(False))
    yes = F.lit(True)
    valid = {"email": yes, "ip": v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), "card": luhn,
             "phone": n.between(9, 15), "account": n.between(12, 19) & ~luhn}
    spans = spans.withColumn("valid", _case({k: yes for k in KINDS} | valid))
    distinct = F.size(F.array_distinct(F.split(F.lower(v), "")))
    vote = lambda c: F.when(c, F.lit(1)).otherwise(F.lit(-1))
    return spans.withColumns({
        "strict": _case({k: vote(v.rlike(STRICT[k])) for k in KINDS}),
        "checksum": F.when(F.col("kind").isin("ip", "card", "phone"), vote(F.col("valid")))
                     .when(F.col("kind") == "account", vote(distinct >= 6))
                     .when(F.col("kind") == "secret", vote((distinct >= 12) & v.rlike("[0-9]")))
                     .otherwise(F.lit(0)),
        "gazetteer": _case({k: vote(v.rlike(GAZETTEER[k])) for k in KINDS}),
        "context": F.when(F.col("before").rlike(AGAINST), -1)
                    .when(_case({k: F.col("before").rlike(CUES[k]) for k in KINDS}), 1)
                    .otherwise(F.lit(0)),
        "size": F.least(F.length("value") / 8, F.lit(4)).cast("int"),
        "share": (4 * F.length("digits") / F.length("value")).cast("int"),
        "upper": v.rlike("[A-Z]").cast("int"),
        "place": F.when(F.length("before") == 0, 0).when(F.col("before").endswith("\n"), 1)
                  .when(F.col("before").endswith(" "), 2).otherwise(F.lit(3))})


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Every row of docs with the named columns, found (all matches of all kinds) and row."""
    d = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    empty = F.array().cast("array<struct<kind:string,i:int,value:string,gap:int,before:string>>")
    parts = [F.coalesce(_matches(F.col("_t"), k), empty) for k in KINDS]
    return d.select(*keep, F.monotonically_increasing_id().alias("row"),
                    solid(F.concat(*parts)).alias("found"))


def candidates(scanned: DataFrame) -> DataFrame:
    """scanned (a written table of scan()) -> a row per match: row, kind, start, end (code
    points, end exclusive), value, valid, the votes, and the features size and share."""
    each = scanned.select("row", F.explode("found").alias("x")).select("row", "x.*")
    order = Window.partitionBy("row", "kind").orderBy("i")
    spans = each.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(
        order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.withColumn("start", F.col("end") - F.length("value"))
    return _checked(spans).select("row", "kind", "start", "end", "value", "valid", *VOTERS, *SEEN)


def reliabilities(patterns: dict[tuple, float], rounds: int = ROUNDS) -> dict[tuple, float]:
    """patterns {(kind, vote, ...): how many spans} -> {the same: probability of being real}.

    Expectation-maximisation of a two-class model: every voter has a distribution over its
    three votes in each class, every kind a share of real spans. It starts from the majority."""
    def start(p):
        s = sum(p[1:])
        return 0.5 if s == 0 else 0.9 if s > 0 else 0.1

    real = {p: start(p) for p in patterns}
    kinds, voters = sorted({p[0] for p in patterns}), range(len(VOTERS))
    for _ in range(rounds):
        share, table = {}, {}
        for k in kinds:
            n = sum(c for p, c in patterns.items() if p[0] == k)
            share[k] = (1 + sum(c * real[p] for p, c in patterns.items() if p[0] == k)) / (2 + n)
        for j in voters:
            for y in (0, 1):
                each = {v: 1.0 for v in (-1, 0, 1)}
                for p, c in patterns.items():
                    each[p[1 + j]] += c * (real[p] if y else 1 - real[p])
                total = sum(each.values())
                table[j, y] = {v: w / total for v, w in each.items()}
        for p in patterns:
            logit = math.log(share[p[0]] / (1 - share[p[0]])) + sum(
                math.log(table[j, 1][p[1 + j]] / table[j, 0][p[1 + j]]) for j in voters)
            real[p] = 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
    return real


def _features(p: tuple) -> list[str]:
    kind, votes, seen = p[0], p[1:1 + len(VOTERS)], p[1 + len(VOTERS):]
    return [kind, *(f"{name}{v}" for name, v in zip(SEEN, seen)),
            *(f"{name}{v}" for name, v in zip(VOTERS, votes) if v)]


def train_classifier(patterns: dict[tuple, float], steps: int = STEPS) -> dict[str, float]:
    """patterns {(kind, votes ..., SEEN ...): how many spans} -> weights by feature.

    A logistic regression on the probabilities that reliabilities() gives the vote patterns,
    by gradient steps over the distinct patterns."""
    votes, by_votes = 1 + len(VOTERS), {}
    for p, c in patterns.items():
        by_votes[p[:votes]] = by_votes.get(p[:votes], 0.0) + c
    real = reliabilities(by_votes)
    total = sum(patterns.values())
    weights: dict[str, float] = {f: 0.0 for p in patterns for f in _features(p)}
    rows = [(_features(p), math.sqrt(c), real[p[:votes]]) for p, c in patterns.items()]
    mass = sum(c for _, c, _ in rows) or 1.0
    for _ in range(steps if total else 0):
        step = {f: -0.001 * w for f, w in weights.items()}
        for feats, c, y in rows:
            z = sum(weights[f] for f in feats)
            d = c / mass * (y - 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            for f in feats:
                step[f] += d
        for f in weights:
            weights[f] += 4.0 * step[f]
    return weights


def _probability(weights: dict[str, float]) -> Column:
    z = F.lit(0.0)
    for f, w in sorted(weights.items()):
        if f in KINDS:
            hit = F.col("kind") == f
        else:
            name = next(n for n in [*VOTERS, *SEEN] if f.startswith(n))
            hit = F.col(name) == int(f[len(name):])
        z = z + F.when(hit, F.lit(w)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def accepted(spans: DataFrame) -> DataFrame:
    """spans (a written table of candidates()) -> row, k (place in KINDS), kind, start, end,
    base: the valid spans of the base kinds and the candidates that the classifier accepts.
    reach is the largest end among the row's earlier spans."""
    groups = (spans.where(F.col("valid") | F.col("kind").isin(*BASE)).groupBy("kind", *VOTERS, *SEEN)
              .agg(F.count("*").alias("n")).collect())
    weights = train_classifier({tuple(r)[:-1]: float(r.n) for r in groups})
    base = F.col("kind").isin(*BASE)
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")) - 1
    kept = spans.where(F.col("valid") & (base | (_probability(weights) >= ACCEPT)))
    kept = kept.select("row", place.cast("int").alias("k"), "kind", "start", "end",
                       base.alias("base"))
    earlier = (Window.partitionBy("row").orderBy("start", "k", "end")
               .rowsBetween(Window.unboundedPreceding, -1))
    return kept.withColumn("reach", F.coalesce(F.max("end").over(earlier), F.lit(0)))


def _found(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    scanned = written(scan(docs, keep))
    spans = accepted(written(candidates(scanned)))
    by_row = spans.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("start", "k", "end", "kind", "base", "reach"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,k:int,end:bigint,kind:string,base:boolean,"
                          "reach:bigint>>")
    # only rows with a match meet the spans; the others, nearly all, are not shuffled
    some = scanned.where(F.size("found") > 0).drop("found").join(by_row, "row", "left")
    return scanned, some.unionByName(
        scanned.where(F.size("found") == 0).drop("found").withColumn("spans", none)
    ).withColumn("spans", F.coalesce("spans", none))


def find(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, any others) -> doc_id, spans (array of start, k, end, kind, base, by
    start and then kind; code points, end exclusive), one row per row of docs.

    Null and empty texts have no spans, repeated rows are searched like any other, an empty
    table gives no rows. Spans of different kinds may overlap, those of one kind do not."""
    return _found(docs.select("doc_id", "text"), ["doc_id"])[1].select("doc_id", "spans")


def masked(docs: DataFrame) -> DataFrame:
    """docs with every found span of text replaced by its kind in angle brackets; n_chars, if
    there, counts the new text. Where spans overlap, the first one's name stands for all."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["text"])
    _, found = _found(packed, ["doc"])
    text = F.col("doc.text")
    d = found.withColumn("c", solid(F.when(F.size("spans") > 0, F.regexp_extract_all(
        text, F.lit("(?s)."), F.lit(0)))))  # characters: slices of them cost no scan
    cut = lambda a, z: F.array_join(F.slice(
        "c", a.cast("int") + 1, F.greatest(z - a, F.lit(0)).cast("int")), "")
    pieces = F.transform("spans", lambda s: F.concat(
        cut(s["reach"], s["start"]),
        F.when(s["start"] >= s["reach"], F.concat(F.lit("<"), s["kind"], F.lit(">")))
        .otherwise(F.lit(""))))
    last = F.get("spans", F.size("spans") - 1)
    rest = cut(F.greatest(last["reach"], last["end"]), F.size("c"))
    out = d.withColumn("new", solid(F.when(F.col("c").isNull(), text).otherwise(
        F.concat(F.array_join(pieces, ""), rest))))
    new = F.col("new")
    cols = []
    for c in docs.columns:
        cols.append(new.alias(c) if c == "text" else
                    F.length(new).cast("long").alias(c) if c == "n_chars" else F.col(f"doc.{c}"))
    return out.select(*cols)


def digest(spans: Column, base_only: bool = False) -> Column:
    """kind:start:end of the spans, joined by commas."""
    chosen = F.filter(spans, lambda s: s["base"]) if base_only else spans
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

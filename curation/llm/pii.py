"""Operator 3: personal data by weak supervision (DataFrame functions only).

Base spans come from four exact patterns.  The method adds spans to them:

1. Candidates are the words that hold a digit or an ``@``.
2. Labelers vote on every candidate (yes, no, or nothing): regular
   expressions on its form, gazetteers on its parts, and context rules on the
   words before it.
3. Expectation-maximisation (Dawid and Skene) over the vote patterns
   estimates how reliable each labeler is, and how likely each pattern means
   personal data.
4. A naive Bayes span classifier is trained on features of the candidates
   with those likelihoods as soft labels.  Candidates it accepts become spans
   of kind ``secret``, ``contact`` or ``number``, unless a base span overlaps.

Scale: texts are read where they lie and never shuffled.  Training sees all
candidates through two grouped counts: one row per vote pattern (3^6 at
most), one per feature value (a few dozen).  Only those counts reach the
driver, where the handful of model numbers is computed; they go back as
literals.  Patterns are possessive, or start at the border of a run, so that
a long run of one character class is read once.

Defined results: null and empty texts have no spans; repeated rows get a row
each and count twice in training; other columns are ignored (``mask`` keeps
them); without candidates the model accepts nothing; equal starts are ordered
by kind as listed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, table

KINDS = ("email", "ip", "card", "phone")
ADDED = ("secret", "contact", "number")
EM_ROUNDS = 30

# The base patterns, written so that they cannot backtrack.
# \G lets a match begin right behind the last one, inside a run.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text that does not match this has no match of the kind.
GATES = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
_IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
CONTEXT = 40


def _digits(s):
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(d):
    """The sum of the digits, every second from the right doubled, is a
    multiple of ten."""
    def add(acc, i):
        x = F.substring(d, -i, 1).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return acc + x - F.when(x > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def _sound(kind: str, s):
    """The check that a match of the pattern must pass."""
    if kind == "ip":
        return s.rlike(rf"\A{_IP_PART}(?:\.{_IP_PART}){{3}}\z")
    n = F.length(_digits(s))
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(_digits(s))).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _matches(df: DataFrame, text: str, pattern: str, gate: str, out: str) -> DataFrame:
    """Add ``out``: all matches in order, as structs s, e (code points), t
    (the match) and c (the ``CONTEXT`` characters before it).

    The matches and the text between them lie in turn, so their lengths add
    up to the places."""
    none = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(F.col(text).rlike(gate), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
                       .otherwise(none))
    df = df.withColumn("_b", F.when(F.size("_m") > 0, F.split(text, pattern, -1)).otherwise(none))
    kind = "array<struct<s:int,e:int,t:string,c:string>>"

    def add(acc, i):
        t, between = F.element_at("_m", i), F.element_at("_b", i)
        s = acc["pos"] + F.length(between)
        before = F.concat(F.right(acc["last"], F.lit(CONTEXT)), F.right(between, F.lit(CONTEXT)))
        item = F.struct(s.alias("s"), (s + F.length(t)).alias("e"), t.alias("t"),
                        F.right(before, F.lit(CONTEXT)).alias("c"))
        return F.struct((s + F.length(t)).alias("pos"), t.alias("last"), F.array_append(acc["out"], item).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("last"), F.array().cast(kind).alias("out"))
    found = F.when(F.size("_m") > 0, F.aggregate(F.sequence(F.lit(1), F.size("_m")), start, add,
                                                 lambda acc: acc["out"])).otherwise(F.array().cast(kind))
    return df.withColumn(out, found).drop("_m", "_b")


# --- labelers ----------------------------------------------------------------

def _vote(yes=None, no=None):
    v = F.lit(0)
    if no is not None:
        v = F.when(no, -1).otherwise(v)
    return F.when(yes, 1).otherwise(v) if yes is not None else v


# The gazetteers and the context words.
HOSTS = ("example", "gmail", "hotmail", "outlook", "yahoo", "proton", "web", "mail")
UNITS = ("st", "nd", "rd", "th", "km", "kg", "cm", "mm", "ms", "gb", "mb", "kb", "px", "am", "pm", "hz", "%")
PERSONAL = ("token", "key", "apikey", "secret", "password", "passwd", "pin", "ssn", "iban", "account", "card", "phone",
            "tel", "call", "mobile", "fax", "mail", "email", "contact", "ip", "address", "login", "user")
PUBLIC = ("version", "license", "licence", "chapter", "page", "section", "figure", "table", "volume", "step", "level",
          "no", "nr", "cc", "by-nc", "by-sa", "by")


def _votes(w, c):
    """The votes on a candidate word ``w`` with the context ``c``."""
    return [
        _vote(w.rlike("[0-9]") & w.rlike(r"\A[0-9A-Fa-f]{24,}\z"), w.rlike(r"\A[0-9]{1,4}(?:[.,:/][0-9]{1,2}){0,2}\z")),
        _vote(w.rlike(r"\A[^@]+@[^@]+\.[A-Za-z0-9]+\z") | w.rlike(r"\A[0-9]{1,3}(?:\.[0-9]{1,3}){3}\z")
              | w.rlike(r"\A[0-9]{13,19}\z")),
        _vote(w.rlike(r"\A\(?[0-9]{2,4}\)?(?:[-./][0-9]{2,6}){1,4}\z"), ~w.rlike("[0-9@].*[0-9@].*[0-9@]")),
        _vote(w.rlike(r"(?i)@.*\b(?:" + "|".join(HOSTS) + r")[0-9]*\."),
              w.rlike(r"(?i)\A[0-9.,]+(?:" + "|".join(UNITS) + r")\z")),
        _vote(c.rlike(r"(?i)\b(?:" + "|".join(PERSONAL) + r")\b[^A-Za-z0-9]{0,6}(?:(?:is|no|number)\b[^A-Za-z0-9]{0,6})?\z")),
        _vote(None, c.rlike(r"(?i)\b(?:" + "|".join(PUBLIC) + r")\b[^A-Za-z0-9]{0,3}\z")),
    ]


N_VOTES = 6


def _features(w, c):
    """Discrete features of a candidate, as name=value strings."""
    n = F.length(_digits(w))
    bucket = lambda x, at: F.concat_ws("", *(F.when(x >= a, "+") for a in at))
    flag = lambda name, cond: F.concat(F.lit(name + "="), F.when(cond, "1").otherwise("0"))
    return F.array(
        F.concat(F.lit("digits="), bucket(n, (1, 3, 5, 8, 13, 20))),
        F.concat(F.lit("length="), bucket(F.length(w), (2, 4, 7, 10, 16, 24, 40))),
        flag("at", w.contains("@")), flag("dot", w.contains(".")), flag("dash", w.contains("-")),
        flag("letters", w.rlike("[A-Za-z]")), flag("hex", w.rlike(r"\A[0-9A-Fa-f]+\z")),
        flag("paren", w.rlike("[()]")), flag("assigned", c.rlike("[=:][^A-Za-z0-9]*\\z")),
        flag("word", c.rlike("[A-Za-z][ ]\\z")))


def _base_spans(kind: str):
    """The sound matches of a kind, as spans."""
    sound = F.filter(f"_{kind}", lambda x: _sound(kind, x["t"]))
    return F.transform(sound, lambda x: F.struct(x["s"].alias("s"), F.lit(KINDS.index(kind)).alias("k"),
                                                 x["e"].alias("e"), F.lit(kind).alias("kind")))


def _count_of(kind: str):
    return F.size(F.filter("_base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def annotate(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_base`` (base spans: s, k, e, kind) and ``_cand``
    (candidates: s, e, w, votes, features, kind)."""
    df = docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
    for kind in KINDS:
        df = _matches(df, "_text", PATTERNS[kind], GATES[kind], f"_{kind}")
    df = df.withColumn("_base", F.array_sort(F.concat(*(_base_spans(k) for k in KINDS))))
    df = df.drop(*(f"_{k}" for k in KINDS))
    df = _matches(df, "_text", CANDIDATE, "[0-9@]", "_words")

    def trimmed(x):
        """The word without signs at its ends, and where that stands."""
        right = F.regexp_replace(x["t"], r"(?<![^A-Za-z0-9)])[^A-Za-z0-9)]++\z", "")
        core = F.regexp_replace(right, r"\A[^A-Za-z0-9(+]++", "")
        s = x["s"] + F.length(right) - F.length(core)
        lead = F.left(right, F.length(right) - F.length(core))
        return F.struct(s.alias("s"), (s + F.length(core)).alias("e"), core.alias("w"),
                        F.concat(x["c"], lead).alias("c"))

    def judged(x):
        kind = F.when(x["w"].contains("@"), "contact").when(x["w"].rlike("[A-Za-z]"), "secret").otherwise("number")
        return F.struct(x["s"].alias("s"), x["e"].alias("e"), x["w"].alias("w"),
                        F.concat_ws(",", *(v.cast("string") for v in _votes(x["w"], x["c"]))).alias("votes"),
                        _features(x["w"], x["c"]).alias("features"), kind.alias("kind"))

    cores = F.filter(F.transform("_words", trimmed), lambda x: F.length(x["w"]) > 0)
    return (df.withColumn("_cores", cores).withColumn("_cand", F.transform("_cores", judged))
            .drop("_words", "_cores", "_text"))


# --- the model ---------------------------------------------------------------

def estimate(patterns: dict[tuple[int, ...], int], rounds: int = EM_ROUNDS) -> tuple[dict, list]:
    """Expectation-maximisation over vote patterns and their counts: the
    likelihood of personal data of each pattern, and for each labeler the
    chance of each vote, by class."""
    post = {p: 1 / (1 + math.exp(-2.0 * sum(p))) for p in patterns}
    rates: list = []
    for _ in range(rounds):
        total = [1e-9 + sum(n * (q if y else 1 - q) for (p, n), q in zip(patterns.items(), post.values()))
                 for y in (0, 1)]
        rates = [{v: [(0.5 + sum(n * (post[p] if y else 1 - post[p]) for p, n in patterns.items() if p[k] == v))
                      / (1.5 + total[y]) for y in (0, 1)] for v in (-1, 0, 1)} for k in range(N_VOTES)]
        prior = [max(t, 1e-9) / sum(total) for t in total]
        for p in patterns:
            log = [math.log(prior[y]) + sum(math.log(rates[k][v][y]) for k, v in enumerate(p)) for y in (0, 1)]
            post[p] = 1 / (1 + math.exp(min(500, log[0] - log[1])))
    return post, rates


def fit(annotated: DataFrame) -> dict:
    """The classifier's log odds: ``bias``, and ``weights`` by feature; with
    the labelers' ``rates``.  ``annotated`` is read twice: pass written
    rows."""
    cand = annotated.select(F.explode("_cand").alias("x")).select("x.votes", "x.features")
    patterns = {tuple(map(int, r[0].split(","))): r[1]
                for r in cand.groupBy("votes").agg(F.count("*")).collect()}  # 3^6 rows at most
    if not patterns:
        return {"bias": -math.inf, "weights": {}, "rates": []}
    post, rates = estimate(patterns)
    yes = sum(n * post[p] for p, n in patterns.items())
    no = sum(patterns.values()) - yes
    likely = F.create_map(*(F.lit(x) for p, q in post.items() for x in (",".join(map(str, p)), q)))
    soft = cand.groupBy("votes", "features").agg(F.count("*").alias("n")).withColumn("p", likely[F.col("votes")])
    # a value of a feature is one of a few: some dozens of rows
    counts = (soft.select(F.explode("features").alias("f"), "n", "p").groupBy("f")
              .agg(F.sum(F.col("n") * F.col("p")), F.sum(F.col("n") * (1 - F.col("p")))).collect())
    weights = {f: math.log((a + 1) / (yes + 2)) - math.log((b + 1) / (no + 2)) for f, a, b in counts}
    return {"bias": math.log(yes + 1e-6) - math.log(no + 1e-6), "weights": weights, "rates": rates}


def spans(annotated: DataFrame, model: dict) -> DataFrame:
    """``annotated`` with ``_spans``: base spans and accepted candidates."""
    if not model["weights"]:
        return annotated.withColumn("_spans", F.col("_base"))
    weight = F.create_map(*(F.lit(x) for f, w in model["weights"].items() for x in (f, w)))
    score = lambda x: F.aggregate(x["features"], F.lit(model["bias"]),
                                  lambda a, f: a + F.coalesce(F.try_element_at(weight, f), F.lit(0.0)))
    clear = lambda x: ~F.exists("_base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))
    order = F.create_map(*(F.lit(x) for k, n in enumerate(ADDED) for x in (n, len(KINDS) + k)))
    added = F.transform(F.filter("_cand", lambda x: (score(x) >= 0) & clear(x)),
                        lambda x: F.struct(x["s"].alias("s"), order[x["kind"]].alias("k"), x["e"].alias("e"),
                                           x["kind"].alias("kind")))
    return annotated.withColumn("_spans", F.array_sort(F.concat("_base", added)))


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; spans that
    overlap become one.  The model is fitted on ``docs`` itself."""
    model = fit(checkpoint(annotate(docs.select(F.col(text_col)), text_col).select("_cand")))
    marked = spans(annotate(docs, text_col), model)
    text = F.col(text_col)

    def step(acc, x):
        more = F.array(F.substring(text, acc["pos"] + 1, x["s"] - acc["pos"]), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))
        return F.struct(F.greatest(acc["pos"], x["e"]).alias("pos"),
                        F.when(x["s"] >= acc["pos"], F.concat(acc["out"], more)).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))
    masked = F.aggregate("_spans", start, step, lambda acc: F.array_join(F.array_append(
        acc["out"], F.substring(text, acc["pos"] + 1, F.length(text))), ""))
    return (marked.withColumn(text_col, F.when(F.size("_spans") > 0, masked).otherwise(text))
            .select(*docs.columns))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all ``documents``."""
    rows = checkpoint(annotate(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    found = spans(rows, fit(rows))
    line = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
    return found.select("doc_id", *map(_count_of, KINDS), F.sha2(line("_base"), 256).alias("base_sha256"),
                        line("_spans").alias("spans"))

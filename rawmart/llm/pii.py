"""Personal data: patterns propose spans, checksums confirm them, nearby context words adjust the score. DataFrame functions only.

Places are code points, end exclusive. Spans of one kind don't overlap (leftmost first); those of two kinds may.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import pick

# The kinds of the contract, in the order in which spans of one start are listed, then the method's own kinds.
# The patterns propose the same matches as the contract's, written with possessive repeats, so that a long run of digits or
# name characters is read once: no backtracking, no recursion of the matcher. ``\G`` lets a match begin where the last ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]{4}){2,7}(?:[\x20]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ipv6": r"(?<![0-9A-Za-z:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}+(?![0-9A-Za-z:])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "key": r"(?<![A-Za-z0-9_-])(?:A(?:KIA|SIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{22,}+|glpat-[A-Za-z0-9_-]{20}|xox[abprs]-[A-Za-z0-9-]{10,}+|sk-[A-Za-z0-9_-]{20,}+"
    r"|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}+|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]*+)(?![A-Za-z0-9_])",
    "private_key": r"-----BEGIN (?:[A-Z0-9]{1,12} ){0,3}PRIVATE KEY-----(?:[^-]*+-----END (?:[A-Z0-9]{1,12} ){0,3}PRIVATE KEY-----)?",
    "secret": r"(?i)(?<![A-Za-z0-9])(?:password|passwd|pwd|secret|api[_-]?key|access[_-]?key|secret[_-]?key|auth[_-]?token|access[_-]?token|token)[\"']?[\x20\t]{0,3}[:=][\x20\t]{0,3}[\"']?[A-Za-z0-9!#$%&*+./@^_~-]{8,}+",
}
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = tuple(PATTERNS)
# A text without this sign has no match of the kind; spares the pattern's run.
NEEDS = {"email": "@", "phone": "+", "ipv6": ":", "ssn": "-", "private_key": "-----BEGIN "}
BASE_SCORE = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ipv6": 0.7, "ssn": 0.6, "key": 0.9, "private_key": 1.0, "secret": 0.7}
CONTEXT = {
    "email": ["mail", "contact", "write", "@"],
    "ip": ["ip", "address", "server", "host"],
    "card": ["card", "visa", "mastercard", "credit", "payment"],
    "phone": ["phone", "tel", "call", "mobile", "fax"],
    "iban": ["iban", "account", "bank", "transfer"],
    "ipv6": ["ip", "address", "server", "host"],
    "ssn": ["ssn", "social", "security", "tax"],
    "key": ["key", "token", "secret", "auth", "aws"],
    "private_key": ["key", "certificate", "ssh"],
    "secret": ["login", "user", "account", "config", "env"],
}
#: words that speak against personal data
AGAINST = ["version", "order", "serial", "isbn", "part no"]
CONTEXT_CHARS = 40


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number (country, check digits, rest; spaces allowed) leaves 1 modulo 97."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(rest: Column, c: Column) -> Column:
        return F.when(c >= "A", (rest * 100 + F.ascii(c) - 55) % 97).otherwise((rest * 10 + F.ascii(c) - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _octet(part: Column) -> Column:
    plain = F.ltrim(part, F.lit("0"))
    return (F.length(plain) <= 3) & (F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)


def _confirmed(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), _octet)
    if kind == "card":
        return F.when(F.length(_digits(m)).between(12, 19), luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "ipv6":  # eight groups, or fewer around one "::"; so no time of day
        groups = F.size(F.filter(F.split(m, ":"), lambda g: g != ""))
        short = (F.size(F.split(m, "::")) == 2) & ~F.contains(m, F.lit(":::")) & groups.between(2, 7) & m.rlike("[0-9]")
        single = ~m.rlike("^:[^:]|[^:]:$")
        return single & (short | (~F.contains(m, F.lit("::")) & (groups == 8)))
    if kind == "ssn":  # areas, groups and serials that were never given out
        return ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    if kind in ("key", "private_key"):
        return F.lit(True)
    if kind == "secret":  # a value of letters and digits or signs, not a word of prose
        value = F.regexp_extract(m, r"[:=][\x20\t]{0,3}[\"']?(.*)$", 1)
        return value.rlike("[A-Za-z]") & value.rlike("[0-9!#$%&*+@^~]")
    return F.when(F.length(F.replace(m, F.lit(" "), F.lit(""))).between(15, 34), mod97(m)).otherwise(False)


def _matches(text: Column, kind: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))
    return F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(F.array().cast("array<string>")) if kind in NEEDS else found


def _spans(text: Column, kind: str, values: Column) -> Column:
    """Confirmed matches of one kind: array of (start, rank of the kind, stop, value). The text is split at the matches for their places."""
    none = F.array().cast("array<struct<start:int,rank:int,stop:int,value:string>>")
    zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def add(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        stop = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), stop.alias("stop"), pair["value"].alias("value"))
        return F.struct(stop.alias("at"), F.when(pair["ok"], F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"))

    gaps = F.slice(F.split(text, PATTERNS[kind]), F.lit(1), F.size(values))
    pairs = F.zip_with(gaps, values, lambda g, v: F.struct(g.alias("gap"), v.alias("value"), _confirmed(kind, v).alias("ok")))
    return F.when(F.size(values) > 0, F.aggregate(pairs, zero, add, lambda s: s["out"])).otherwise(none)


def _score(text: Column, span: Column) -> Column:
    """Base score of the kind, plus 0.2 for a fitting context word, minus 0.3 for one that speaks against, within 0 and 1."""
    left = F.greatest(span["start"] - CONTEXT_CHARS, F.lit(0))
    near = F.lower(F.concat_ws(" ", F.substr(text, left + 1, span["start"] - left), F.substr(text, span["stop"] + 1, F.lit(CONTEXT_CHARS))))
    score = F.lit(0.0)
    for rank, kind in enumerate(KINDS):
        score = F.when(span["rank"] == rank, F.lit(BASE_SCORE[kind]) + F.when(near.rlike(r"\b(?:" + "|".join(w for w in CONTEXT[kind] if w != "@") + ")"), 0.2).otherwise(0.0)).otherwise(score)
    score = score - F.when(near.rlike(r"\b(?:" + "|".join(AGAINST) + r")\b"), 0.3).otherwise(0.0)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)), 2)


def _with_found(rows: DataFrame) -> DataFrame:
    """``rows`` with the confirmed spans of column ``text`` as column ``found``."""
    rows = rows.withColumns({f"m_{k}": _matches(F.col("text"), k) for k in KINDS})
    rows = rows.withColumn("found", F.array_sort(F.concat(*[_spans(F.col("text"), k, F.col(f"m_{k}")) for k in KINDS])))
    return rows.drop(*[f"m_{k}" for k in KINDS])


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Row for each row of ``docs``: doc_id, spans (array of kind, start, stop, value, score; by start, then kind).

    Kinds: email, ip, card (12 to 19 digits, Luhn), phone (9 to 15 digits), and the method's own: iban (mod 97), ipv6 (number of
    groups), ssn (ranges given out), key (formats of access keys and tokens), private_key, and secret (what is assigned to a
    password, key or token, if it is no plain word). The score never drops a confirmed span. A null or empty text has no spans. Repeated rows give repeated rows; ids may be null.
    Each text is read whole, a few times over, whatever its length. ``with_text`` keeps the text as column ``text``.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").alias("doc_id"), text.alias("text"))
    found = _with_found(rows)
    kinds = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform("found", lambda s: F.struct(kinds[s["rank"]].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), s["value"].alias("value"), _score(F.col("text"), s).alias("score")))
    return found.select("doc_id", *(["text"] if with_text else []), spans.alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:stop of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs``, by position, with the spans in the text column replaced by their kinds; null texts stay null."""
    names = docs.columns
    flat = docs.toDF(*["text" if i == names.index(text_col) else f"_c{i}" for i in range(len(names))])
    found = _with_found(flat)
    kinds = F.array(*[F.lit(k) for k in KINDS])
    spans = F.transform(F.coalesce("found", F.array().cast(found.schema["found"].dataType)), lambda s: F.struct(kinds[s["rank"]].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop")))
    found = found.withColumn("found", spans).withColumn("text", redact(F.col("text"), F.col("found")))
    return found.drop("found").toDF(*names)


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in square brackets; of spans that overlap, the first one in order names the whole."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        out = F.concat(state["out"], F.substr(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), F.when(fresh, out).otherwise(state["out"]).alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, zero, add, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text)))))

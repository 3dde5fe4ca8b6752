r"""Personal data in texts: base expressions, and further spans chosen by boosted trees.

DataFrame and SQL functions only.  A scan finds, per kind, the base spans and the
candidates of a high-recall generator: looser expressions whose spans overlap the
base spans and each other.  A candidate has format features (digits, groups,
separators, checksum) and context features (characters around it, a cue word
before it).  Candidates that a base expression would confirm are labelled 1; what
confirms them in the text itself (a plus sign, an at sign, plain separators) is
not a feature, so the trees also score spans written another way.

* The labelled candidates of all documents are counted per distinct feature
  vector; gradient-boosted trees learn from these counts (one fold of documents
  left out), so the training table is bounded by the features' grid.
* Per kind, the threshold is the least score from which on candidates of the
  left-out fold are right with `PRECISION`, `LEAST_SCORE` at least; a kind that doesn't
  reach it adds nothing.
* The trees become one SQL expression: documents are scored where they are,
  without a join or a shuffle.

The expressions are those of the contract, written so that Java's matcher neither
recurses nor scans a stretch twice: possessive where nothing after can need a
character back, and started only where a stretch begins or the last match ended.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spillway.llm.common import Workspace

PRECISION = 0.9      # of the candidates selected, on the left-out fold
LEAST_SUPPORT = 20   # left-out candidates above a threshold
LEAST_SCORE = 0.5    # no threshold is lower
ROUNDS, DEPTH = 20, 4
LEAST_LEAF = 0.01    # share of the candidates in a leaf: rare forms can't be learned by heart
FOLDS = 5            # fold 0 of crc32(doc_id) calibrates

BASE_KINDS = ("email", "ip", "card", "phone")
LOOSE_KINDS = ("email_like", "ip_like", "card_like", "phone_like")
_LOCAL = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
_FREE = rf"(?:\G|(?<!{_LOCAL}))"
EXPRESSIONS = {
    "email": rf"{_FREE}{_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_like": rf"{_FREE}{_LOCAL}++(?:@|\x20?[\[(](?:at|AT|@)[\])]\x20?){_LABEL}++"
                  rf"(?:(?:\.|\x20?[\[(](?:dot|DOT|\.)[\])]\x20?|\x20dot\x20){_LABEL}++)++",
    "ip_like": r"[0-9](?<![0-9.][0-9])[0-9]{0,2}+(?:(?:\.|\[\.\]|\(\.\)|\x20\.\x20)[0-9]{1,3}+){3}(?![0-9])",
    "card_like": r"[0-9](?<![0-9]{2})(?:[\x20./-]?[0-9]){12,18}+(?![0-9])",
    "phone_like": r"[0-9(](?<![0-9A-Za-z.][0-9(])(?:(?<=\()[0-9])?+(?<=[0-9])(?:[\x20().-]{0,2}+[0-9]){6,14}+(?![0-9A-Za-z])",
}
# What a text with the kind has, found faster than the kind itself; each is looked for once.
HINTS = {"at": r"@|[\[(](?:at|AT)[\])]", "plus": r"\+[0-9]", "numeric": r"[0-9](?:[\x20()./-]{0,2}+[0-9]){6}",
         "dotted": r"[0-9]\x20?[\[(]?\."}
HINT_OF = {"email": "at", "email_like": "at", "phone": "plus", "card": "numeric", "card_like": "numeric", "phone_like": "numeric",
           "ip": "dotted", "ip_like": "dotted"}
# Words before a span that tell its kind, in the languages of the documents.
CUES = ("phone|call|tel|fax|mobile|anruf|telefon|appel|llam", "mail|write to|contact|schreib|correo|courriel",
        "card|visa|credit|karte|carte|tarjeta", r"\bip\b|host|server|address|adresse", "token|key|secret|password|hash|id")
CONTEXT = 32  # characters before a span that are searched for a cue
_SPAN_BLOCK = 256  # spans whose places are summed in one fold

FEATURES = ("kind", "digits", "groups", "longest", "shape", "luhn", "small_parts", "before", "after", "cue")


def _sql(text: str) -> str:
    return "r\"" + text.replace('"', '\\"') + "\"" if '"' not in text else "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _luhn(digits: str) -> str:
    """SQL: whether a string of digits passes the Luhn check."""
    d = f"(ascii(substring({digits}, length({digits}) - i, 1)) - 48)"
    return (f"(aggregate(sequence(0, length({digits}) - 1), 0, (acc, i) -> acc + case when i % 2 = 0 then {d}"
            f" when {d} > 4 then 2 * {d} - 9 else 2 * {d} end) % 10 = 0)")


_SMALL = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_QUAD = rf"^{_SMALL}(?:\.{_SMALL}){{3}}$"


def _cuts(rows: DataFrame) -> DataFrame:
    """Per kind its matches in order, and the text before, between and behind them where there are any."""
    none = F.array().cast("array<string>")
    hinted = rows.select("doc_id", "text", *(F.col("text").rlike(h).alias(f"has_{name}") for name, h in HINTS.items()))
    hits = {k: F.when(F.col(f"has_{HINT_OF[k]}"), F.regexp_extract_all("text", F.lit(e), F.lit(0))).otherwise(none) for k, e in EXPRESSIONS.items()}
    found = hinted.select("doc_id", "text", *(h.alias(f"{k}_hits") for k, h in hits.items()))
    gaps = {k: F.when(F.size(f"{k}_hits") > 0, F.split("text", e, -1)).otherwise(none) for k, e in EXPRESSIONS.items()}
    return found.select("doc_id", *(f"{k}_hits" for k in EXPRESSIONS), *(g.alias(f"{k}_gaps") for k, g in gaps.items()))


def _pieces(kind: str) -> Column:
    """Array of (gap, hit, next gap)."""
    hits, gaps = F.col(f"{kind}_hits"), F.col(f"{kind}_gaps")
    pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    return F.zip_with(pairs, F.slice(gaps, 2, F.size(hits)), lambda p, n: F.struct(
        p["gap"].alias("gap"), p["hit"].alias("hit"), n.alias("next"))).alias(kind)


def _placed(pieces: str) -> str:
    """SQL: the pieces with start and end in code points.

    Places are running sums, folded in blocks of `_SPAN_BLOCK` spans (a fold
    copies what it has) whose bases are folded first.
    """
    blocks = f"sequence(0, (size({pieces}) - 1) div {_SPAN_BLOCK})"
    part = f"slice({pieces}, b * {_SPAN_BLOCK} + 1, {_SPAN_BLOCK})"
    total = f"aggregate({part}, 0L, (acc, p) -> acc + char_length(p.gap) + char_length(p.hit))"
    bases = f"aggregate(transform({blocks}, b -> {total}), array(0L), (acc, n) -> concat(acc, array(element_at(acc, -1) + n)))"
    empty = "cast(array() as array<struct<start: bigint, end: bigint, gap: string, hit: string, next: string>>)"
    step = ("named_struct('at', acc.at + char_length(p.gap) + char_length(p.hit), 'out', concat(acc.out, array(named_struct("
            "'start', acc.at + char_length(p.gap), 'end', acc.at + char_length(p.gap) + char_length(p.hit),"
            " 'gap', p.gap, 'hit', p.hit, 'next', p.next))))")
    return (f"case when size({pieces}) = 0 then {empty} else flatten(zip_with({blocks}, slice({bases}, 1, size({blocks})),"
            f" (b, base) -> aggregate({part}, named_struct('at', base, 'out', {empty}), (acc, p) -> {step}, acc -> acc.out))) end")


def _kept(kind: str) -> str:
    """SQL: whether a base match x passes its check."""
    return {"email": "true", "ip": f"x.hit rlike {_sql(_QUAD)}", "card": f"length(x.digits) between 16 and 19 and {_luhn('x.digits')}",
            "phone": "length(x.digits) between 8 and 15"}[kind]


def _candidate(kind: str) -> str:
    """SQL: the label and the features of a candidate x."""
    k = LOOSE_KINDS.index(kind)
    label = {"email_like": f"x.hit rlike {_sql('^' + _LOCAL + '+@' + _LABEL + '+([.]' + _LABEL + '+)+$')}",
             "ip_like": f"x.hit rlike {_sql(_QUAD)}",
             "card_like": f"length(x.digits) between 16 and 19 and not x.hit rlike '[./]' and {_luhn('x.digits')}",
             "phone_like": "endswith(x.gap, '+') and length(x.digits) between 8 and 15"}[kind]
    luhn = f"case when {_luhn('x.digits')} then 1 else 0 end" if kind == "card_like" else "0"
    shape = ("case when contains(x.hit, '(') then 1 else 0 end + case when contains(x.hit, '-') then 2 else 0 end"
             " + case when contains(x.hit, ' ') then 4 else 0 end + case when contains(x.hit, '.') then 8 else 0 end") if kind == "phone_like" else "0"
    small = f"case when x.runs_joined rlike {_sql(_QUAD)} then 1 else 0 end" if kind == "ip_like" else "0"
    side = lambda c: (f"case when {c} = '' or {c} rlike '[ \\\\n\\\\t+]' then 0 when {c} rlike '[A-Za-z]' then 1"  # noqa: E731
                      f" when {c} rlike '[0-9]' then 2 else 3 end")
    cue = "case " + " ".join(f"when x.context rlike {_sql('(?i)' + words)} then {i + 1}" for i, words in enumerate(CUES)) + " else 0 end"
    return (f"named_struct('kind', {k}, 'start', x.start, 'end', x.end, 'label', case when {label} then 1 else 0 end,"
            f" 'digits', least(length(x.digits), 24), 'groups', least(size(x.runs), 8), 'longest', least(coalesce(array_max(transform(x.runs, r -> length(r))), 0), 20),"
            f" 'shape', {shape}, 'luhn', {luhn}, 'small_parts', {small}, 'before', {side('right(x.gap, 1)')}, 'after', {side('left(x.next, 1)')},"
            f" 'cue', {cue})")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base (kind, start, end) and candidates (kind, start, end, label, features) of every whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = _cuts(rows).select("doc_id", *(_pieces(k) for k in EXPRESSIONS))
    rows = rows.select("doc_id", *(F.expr(_placed(k)).alias(k) for k in EXPRESSIONS))
    with_digits = "x -> named_struct('start', x.start, 'end', x.end, 'hit', x.hit, 'digits', translate(x.hit, '+ ().-', ''))"
    base = ", ".join(f"transform(filter(transform({k}, {with_digits}), x -> {_kept(k)}),"
                     f" x -> named_struct('kind', '{k}', 'start', x.start, 'end', x.end))" for k in BASE_KINDS)
    detailed = ("x -> named_struct('start', x.start, 'end', x.end, 'gap', x.gap, 'hit', x.hit, 'next', x.next,"
                " 'digits', regexp_replace(x.hit, '[^0-9]', ''), 'runs', regexp_extract_all(x.hit, '[0-9]+', 0),"
                f" 'runs_joined', array_join(regexp_extract_all(x.hit, '[0-9]+', 0), '.'), 'context', right(x.gap, {CONTEXT}))")
    loose = ", ".join(f"transform(transform({k}, {detailed}), x -> {_candidate(k)})" for k in LOOSE_KINDS)
    return rows.select("doc_id", F.expr(f"concat({base})").alias("base"), F.expr(f"concat({loose})").alias("candidates"))


def vectors(found: DataFrame) -> DataFrame:
    """Candidates counted by feature vector, label and fold: what the trees learn from."""
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)).cast("int")
    return (found.select(fold.alias("fold"), F.explode("candidates").alias("c"))
            .groupBy("fold", F.col("c.label").alias("label"), *(F.col(f"c.{f}").alias(f) for f in FEATURES)).agg(F.count("*").alias("n")))


def _tree_sql(lines: list[str], at: int, item: str) -> tuple[str, int]:
    """SQL of the printed tree whose first line is `at`, and the line behind it."""
    if (leaf := re.fullmatch(r"\s*Predict: (\S+)", lines[at])):
        return f"{float(leaf[1])!r}D", at + 1
    feature, bound = re.fullmatch(r"\s*If \(feature (\d+) <= (\S+)\)", lines[at]).groups()
    low, at = _tree_sql(lines, at + 1, item)
    high, at = _tree_sql(lines, at + 1, item)  # behind the line of the else
    return f"case when {item}.{FEATURES[int(feature)]} <= {float(bound)!r}D then {low} else {high} end", at


def _score_sql(model, item: str) -> str:
    """The model's probability of label 1 as a SQL expression over the fields of `item`."""
    trees = [f"{float(w)!r}D * ({_tree_sql([x for x in t.toDebugString.splitlines()[1:] if x.strip()], 0, item)[0]})"
             for t, w in zip(model.trees, model.treeWeights, strict=True)]
    return f"(1D / (1D + exp(-2D * ({' + '.join(trees)}))))"


def learn(counted: DataFrame) -> tuple[str, dict[int, float]]:
    """(SQL score of a candidate c, threshold by kind) from counted feature vectors; no thresholds where nothing was learned."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(counted)
    taught = rows.where("fold <> 0")
    if taught.select("label").distinct().count() < 2:
        return "0D", {}
    model = GBTClassifier(featuresCol="x", labelCol="label", weightCol="n", maxIter=ROUNDS, maxDepth=DEPTH,
                          minWeightFractionPerNode=LEAST_LEAF, seed=1, maxBins=32).fit(
        taught.select("x", F.col("label").cast("double").alias("label"), F.col("n").cast("double").alias("n")))
    score = _score_sql(model, "c")
    held = counted.where("fold = 0").select("label", "n", "kind", F.round(F.expr(score.replace("c.", "")), 3).alias("score"))
    bins = held.groupBy("kind", "score").agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("right"))
    falling = Window.partitionBy("kind").orderBy(F.desc("score"))  # at most 1,001 scores a kind
    above = falling.rowsBetween(Window.unboundedPreceding, 0)
    # A threshold may lie anywhere above the next lower score that was seen.
    least = F.greatest(F.lit(LEAST_SCORE), F.coalesce(F.lead("score").over(falling) + F.lit(0.001), F.lit(LEAST_SCORE)))
    good = (bins.select("kind", least.alias("least"), F.sum("n").over(above).alias("n"), F.sum("right").over(above).alias("right"))
            .where((F.col("right") >= PRECISION * F.col("n")) & (F.col("n") >= LEAST_SUPPORT)))
    return score, {r["kind"]: r["least"] for r in good.groupBy("kind").agg(F.min("least").alias("least")).collect()}


def find_personal_data(docs: DataFrame, work: Workspace) -> DataFrame:
    """doc_id, spans: an array of (kind, start, end, score) per document, by kind (as `BASE_KINDS`, then `LOOSE_KINDS`) and start.

    Offsets are code points, the end is exclusive; base spans have no score.
    Null and empty texts have no spans; texts are scanned whole whatever their
    length; repeated rows stay rows (and count in training); a null doc_id is a
    row like others; an empty table gives no rows; other columns are not read.
    """
    found = work.write(scan(docs), "found")
    score, thresholds = learn(work.write(vectors(found), "vectors"))
    kinds = "array(" + ", ".join(f"'{k}'" for k in LOOSE_KINDS) + ")"
    bound = "case c.kind " + " ".join(f"when {k} then {t!r}D" for k, t in thresholds.items()) + " else 2D end" if thresholds else "2D"
    scored = f"transform(filter(candidates, c -> c.label = 0), c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'score', {score}))"
    added = (f"transform(filter({scored}, c -> round(c.score, 3) >= {bound}),"
             f" c -> named_struct('kind', element_at({kinds}, c.kind + 1), 'start', c.start, 'end', c.end, 'score', c.score))")
    return found.select("doc_id", F.expr(
        "concat(transform(base, x -> named_struct('kind', x.kind, 'start', x.start, 'end', x.end, 'score', cast(null as double))), "
        f"{added})").alias("spans"))

"""Queries over consent messages, popup text, button labels, the corpus and consent rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from crawlprism import registry
from crawlprism.catalog import bridge as b
from crawlprism.catalog import sqlparts as q
from crawlprism.catalog.register import query
from crawlprism.functions import text as tx
from crawlprism.functions import urls
from crawlprism.operators import consent as cs
from crawlprism.operators import corpus as cp
from crawlprism.operators import detection as det
from crawlprism.operators import shred
from crawlprism.patterns import default_patterns
from crawlprism.plans import rules as ru
from crawlprism.session import materialize, shared_dir

P = default_patterns()
MSG = b.oracle(b.MESSAGES)

# --- messages ----------------------------------------------------------------------------------

_CMPS = f"""m AS ({MSG}),
pg AS (SELECT page, arg_min(cmp, seq) FILTER (type = 'consentDone') AS done, arg_min(coalesce(result, FALSE), seq) FILTER (type = 'selfTestResult') AS st FROM m GROUP BY page),
cm AS (SELECT page, cmp, min(seq) FILTER (type = 'cmpDetected') AS first_seq, bool_or(type = 'popupFound') AS open, arg_min(result, seq) FILTER (type = 'optOutResult') AS res
  FROM m WHERE type IN ('cmpDetected', 'popupFound', 'optOutResult') GROUP BY page, cmp),
res AS (SELECT page, cmp AS name, first_seq, coalesce(done = cmp, FALSE) AS final, open, open AS started, open AND coalesce(res, FALSE) AS succeeded,
  coalesce(NOT st, FALSE) AS "selfTestFail", FALSE AS "filterListMatched" FROM cm JOIN pg USING (page) WHERE first_seq IS NOT NULL)"""


@query("cmp_results", f"WITH {_CMPS} SELECT * FROM res")
def cmp_results(spark, sf):
    return cs.cmp_results(b.messages(spark, sf), "optOut")


@query(
    "cmp_results_passive",
    f'WITH {_CMPS} SELECT page, name, first_seq, final, open, FALSE AS started, FALSE AS succeeded, "selfTestFail", "filterListMatched" FROM res',
)
def cmp_results_passive(spark, sf):
    return cs.cmp_results(b.messages(spark, sf))


@query("cmp_errors", f"SELECT page, seq, details AS error FROM ({MSG}) WHERE type = 'consentError'")
def cmp_errors(spark, sf):
    return cs.cmp_errors(b.messages(spark, sf))


_EVIDENCE = f"""SELECT page, evidence, value, min(seq) AS first_seq FROM (
  SELECT page, seq, 'pattern' AS evidence, pattern AS value FROM ({MSG}) WHERE type = 'report'
  UNION ALL SELECT page, seq, 'snippet', snippet FROM ({MSG}) WHERE type = 'report'
  UNION ALL SELECT page, seq, 'snippet', 'common' FROM ({MSG}) WHERE type = 'report') GROUP BY page, evidence, value"""


@query("heuristic_evidence", _EVIDENCE)
def heuristic_evidence(spark, sf):
    return cs.heuristic_evidence(b.messages(spark, sf))


@query(
    "heuristic_scan",
    f"""SELECT page, '' AS name, CAST(NULL AS BIGINT) AS first_seq, FALSE AS final, FALSE AS open, FALSE AS started, FALSE AS succeeded, FALSE AS "selfTestFail",
    FALSE AS "filterListMatched" FROM ({MSG}) GROUP BY page HAVING bool_or(type = 'report') AND NOT bool_or(type = 'cmpDetected')""",
)
def heuristic_scan(spark, sf):
    return cs.heuristic_scan(b.messages(spark, sf))


@query(
    "nest_cmps",
    f"""WITH {_CMPS}, x AS (SELECT page, name, final, first_seq FROM res UNION ALL SELECT page, '', FALSE, NULL FROM ({MSG}) GROUP BY page
      HAVING bool_or(type = 'report') AND NOT bool_or(type = 'cmpDetected')),
    er AS (SELECT page, string_agg(details, ',' ORDER BY seq) AS errors FROM m WHERE type = 'consentError' GROUP BY page),
    ev AS (SELECT page, string_agg(value, ',' ORDER BY first_seq, value) FILTER (evidence = 'pattern') AS patterns,
      string_agg(value, ',' ORDER BY first_seq, value) FILTER (evidence = 'snippet') AS snippets FROM ({_EVIDENCE}) GROUP BY page)
    SELECT x.page, string_agg(name || '/' || CASE WHEN final THEN 'true' ELSE 'false' END || '/' || CASE WHEN name = '' THEN '' ELSE coalesce(errors, '') END || '/' || coalesce(patterns, '') || '/' || coalesce(snippets, ''), '|' ORDER BY first_seq) AS cmps
    FROM x LEFT JOIN er USING (page) LEFT JOIN ev USING (page) GROUP BY x.page""",
)
def nest_cmps(spark, sf):
    """The cmps section of page documents, built from messages."""
    text = F.transform(
        "cmps",
        lambda c: F.concat_ws("/", c["name"], c["final"].cast("string"), *[F.array_join(c[f], ",") for f in ("errors", "patterns", "snippets")]),
    )
    return cs.nest_cmps(b.messages(spark, sf), "optOut").select("page", F.array_join(text, "|").alias("cmps"))


@query(
    "frame_performance",
    f"""SELECT page, "frameUrl", arg_max("isMainFrame", seq) AS "isMainFrame", CAST(max(seq) AS DOUBLE) AS "filterCMPs" FROM
    (SELECT *, regexp_replace(url, '[?#].*$', '') AS "frameUrl" FROM ({MSG}) WHERE type = 'report') WHERE "frameUrl" <> '' GROUP BY page, "frameUrl" """,
)
def frame_performance(spark, sf):
    perf = cs.frame_performance(b.messages(spark, sf))
    return perf.select("page", "frameUrl", "isMainFrame", F.col("performance.filterCMPs")[0].alias("filterCMPs"))


# --- frames, popups, buttons ----------------------------------------------------------------------

POS = ("frame", "popup", "button")


def _long(df):
    for c in (*POS, "buttonCount"):
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast("bigint"))
    return df


def frames(spark, sf):
    return shred.to_frames(b.scraped(spark, sf))


def popups(spark, sf):
    return shred.to_popups(b.scraped(spark, sf))


def buttons(spark, sf):
    return shred.to_buttons(b.scraped(spark, sf))


# Verdicts of an outside judge, one per distinct text: a rule stands in for the judge.
def text_verdicts(df, column):
    texts = df.select(tx.trim_space(F.col(column)).alias("text")).filter("text <> ''").distinct()
    return texts.select("text", (F.length("text") % 3 != 0).alias("verdict"))


def button_verdicts(spark, sf):
    labels = buttons(spark, sf).select(tx.clean_button_text(F.col("text")).alias("text")).distinct()
    picked = F.element_at(F.array(*[F.lit(x) for x in det.LABELS]), (F.length("text") % 5 + 1).cast("int"))
    return labels.filter("length(text) % 7 <> 0").select("text", picked.alias("verdict"))


_T = q.trim("text")
O_CPOPUPS = f"""SELECT *, {_T} <> '' AND {q.noticed(f'lower({_T})', P)} AS regexmatch, {_T} <> '' AND length({_T}) % 3 <> 0 AS llmmatch FROM ({b.O_POPUPS})"""
_CLEAN = q.clean("text")
_VERDICT = b.pick("length(label)", det.LABELS)
O_LABELLED = f"""SELECT bt.*, pp.regexmatch, pp.llmmatch, coalesce(bt.text <> '' AND NOT {q.found('label', P.never)} AND {q.found('label', P.reject)}, FALSE) AS isreject,
  CASE WHEN regexmatch OR llmmatch THEN CASE WHEN length(label) > 200 OR length(label) % 7 = 0 THEN 'other' ELSE {_VERDICT} END END AS llmclass,
  CASE WHEN regexmatch OR llmmatch THEN {q.classified('label', P)} END AS regexclass
  FROM (SELECT *, {_CLEAN} AS label FROM ({b.O_BUTTONS})) bt JOIN ({O_CPOPUPS}) pp USING (page, frame, popup)"""


@query("to_frames", f'SELECT page, frame, istop AS "isTop", origin, cleanedtext AS "cleanedText", buttoncount AS "buttonCount" FROM ({b.O_FRAMES})')
def to_frames(spark, sf):
    return _long(frames(spark, sf))


@query("to_popups", f'SELECT page, frame, popup, istop AS "isTop", origin, text, selector FROM ({b.O_POPUPS})')
def to_popups(spark, sf):
    return _long(popups(spark, sf)).drop("buttons")


@query("to_buttons", f'SELECT page, frame, popup, button, istop AS "isTop", origin, text, selector FROM ({b.O_BUTTONS})')
def to_buttons(spark, sf):
    return _long(buttons(spark, sf))


@query(
    "keep_frames",
    f"""SELECT d.page, count(f.page) AS kept FROM (SELECT doc_id AS page FROM documents) d LEFT JOIN (SELECT f.page, f.frame FROM ({b.O_FRAMES}) f
    LEFT JOIN (SELECT DISTINCT page, frame, TRUE AS has FROM ({b.O_POPUPS})) p USING (page, frame) WHERE cleanedtext <> '' OR has) f ON f.page = d.page GROUP BY d.page""",
)
def keep_frames(spark, sf):
    kept = shred.keep_frames(F.col("data.cookiepopups.scrapedFrames"))
    return b.scraped(spark, sf).select("page", F.size(kept).cast("bigint").alias("kept"))


@query("clean_button_text", f"SELECT page, frame, popup, button, {_CLEAN} AS label FROM ({b.O_BUTTONS})")
def clean_button_text(spark, sf):
    return _long(buttons(spark, sf)).select("page", *POS, tx.clean_button_text(F.col("text")).alias("label"))


@query("popup_text_match", f"SELECT doc_id, {q.noticed('lower(text)', P)} AS plain, {q.noticed('lower(cleanedtext)', P)} AS seeded FROM documents LEFT JOIN ({b.O_FRAMES}) ON page = doc_id AND frame = 0")
def popup_text_match(spark, sf):
    docs = b.spark_sql(spark, sf, "SELECT doc_id, text FROM $documents")
    top = b.scraped(spark, sf).select(F.col("page").alias("doc_id"), F.try_element_at("data.cookiepopups.scrapedFrames", F.lit(1))["cleanedText"].alias("t"))
    both = docs.join(top.filter("t IS NOT NULL"), "doc_id", "left")
    return both.select("doc_id", det.popup_text_match(F.col("text")).alias("plain"), det.popup_text_match(F.col("t")).alias("seeded"))


@query(
    "is_reject_button",
    f"SELECT page, frame, popup, button, text <> '' AND NOT {q.found('label', P.never)} AND {q.found('label', P.reject.with_exact(['powered by x']))} AS reject FROM (SELECT *, {_CLEAN} AS label FROM ({b.O_BUTTONS}))",
)
def is_reject_button(spark, sf):
    extra = P.with_extra_rejects(["powered by x"])
    return _long(buttons(spark, sf)).select("page", *POS, det.is_reject_button(F.col("text"), extra).alias("reject"))


@query("match_patterns", f"SELECT label, count(*) AS n, bool_or(NOT {q.found('label', P.never)} AND {q.found('label', P.settings)}) AS settings FROM (SELECT {_CLEAN} AS label FROM ({b.O_BUTTONS})) GROUP BY label")
def match_patterns(spark, sf):
    m = buttons(spark, sf).select(tx.clean_button_text(F.col("text")).alias("label"), det.match_patterns(F.col("text"), P.settings, P.never).alias("m"))
    return m.groupBy("label").agg(F.count("*").alias("n"), F.bool_or("m").alias("settings"))


@query("classify_button", f'SELECT page, frame, popup, button, {q.classified("label", P)} AS "regexClassification" FROM (SELECT *, {_CLEAN} AS label FROM ({b.O_BUTTONS}))')
def classify_button(spark, sf):
    return det.classify_button(_long(buttons(spark, sf)), "text").select("page", *POS, "regexClassification")


@query(
    "split_reject_buttons",
    f"""SELECT page, frame, popup, coalesce(string_agg(text, '|' ORDER BY button) FILTER (isreject), '') AS reject, coalesce(string_agg(text, '|' ORDER BY button) FILTER (NOT isreject), '') AS other
    FROM ({O_LABELLED}) GROUP BY page, frame, popup""",
)
def split_reject_buttons(spark, sf):
    rows = b.scraped(spark, sf).select("page", F.posexplode("data.cookiepopups.scrapedFrames").alias("frame", "f"))
    rows = rows.select("page", "frame", F.posexplode("f.potentialPopups").alias("popup", "p")).filter(F.size("p.buttons") > 0)
    split = _long(rows).withColumn("s", det.split_reject_buttons(F.col("p.buttons")))
    text = lambda c: F.array_join(F.transform(f"s.{c}", lambda x: x["text"]), "|")
    return split.select("page", "frame", "popup", text("rejectButtons").alias("reject"), text("otherButtons").alias("other"))


@query(
    "attach_verdicts",
    f"""SELECT page, frame, popup, button, label, CASE WHEN length(label) > 200 OR length(label) % 7 = 0 THEN 'other' ELSE {_VERDICT} END AS "llmClassification"
    FROM (SELECT *, {_CLEAN} AS label FROM ({b.O_BUTTONS}))""",
)
def attach_verdicts(spark, sf):
    judged = det.judge_buttons(_long(buttons(spark, sf)), button_verdicts(spark, sf))
    return judged.select("page", *POS, "label", "llmClassification")


def classified_popups(spark, sf):
    p = popups(spark, sf)
    return det.classify_popups(p, text_verdicts(p, "text"))


@query("classify_popups", f'SELECT page, frame, popup, regexmatch AS "regexMatch", llmmatch AS "llmMatch" FROM ({O_CPOPUPS})')
def classify_popups(spark, sf):
    return _long(classified_popups(spark, sf)).select("page", "frame", "popup", "regexMatch", "llmMatch")


def labelled(spark, sf):
    return det.label_popup_buttons(classified_popups(spark, sf), button_verdicts(spark, sf))


@query(
    "label_popup_buttons",
    f'SELECT page, frame, popup, button, isreject AS "isReject", llmclass AS "llmClassification", regexclass AS "regexClassification" FROM ({O_LABELLED})',
)
def label_popup_buttons(spark, sf):
    return _long(labelled(spark, sf)).select("page", *POS, "isReject", "llmClassification", "regexClassification")


O_CFRAMES = f"""SELECT f.*, el AND (coalesce(conf, FALSE) OR length({q.trim('cleanedtext')}) % 3 <> 0) AS llmdetected, el AND {q.noticed('lower(cleanedtext)', P)} AS regexdetected FROM
  (SELECT *, cleanedtext <> '' AND (istop OR buttoncount > 0) AS el FROM ({b.O_FRAMES})) f
  LEFT JOIN (SELECT page, frame, bool_or(llmmatch) AS conf FROM ({O_CPOPUPS}) GROUP BY page, frame) c USING (page, frame)"""


def classified_frames(spark, sf):
    f = frames(spark, sf)
    verdicts = f.select("cleanedText").distinct().select(
        F.col("cleanedText").alias("text"), (F.length(tx.trim_space(F.col("cleanedText"))) % 3 != 0).alias("verdict")
    )
    return det.classify_frames(f, classified_popups(spark, sf), verdicts)


@query("classify_frames", f'SELECT page, frame, llmdetected AS "llmPopupDetected", regexdetected AS "regexPopupDetected" FROM ({O_CFRAMES})')
def classify_frames(spark, sf):
    return _long(classified_frames(spark, sf)).select("page", "frame", "llmPopupDetected", "regexPopupDetected")


O_FLAGS = f"""SELECT page, bool_or(a) AS "textLlm", bool_or(b) AS "textRegex", bool_or(c) AS "elementLlm", bool_or(d) AS "elementRegex" FROM (
  SELECT page, llmdetected AS a, regexdetected AS b, FALSE AS c, FALSE AS d FROM ({O_CFRAMES})
  UNION ALL SELECT page, FALSE, FALSE, llmmatch, regexmatch FROM ({O_CPOPUPS})) GROUP BY page"""


def flags(spark, sf):
    return det.page_popup_flags(classified_frames(spark, sf), classified_popups(spark, sf))


@query("page_popup_flags", O_FLAGS)
def page_popup_flags(spark, sf):
    return flags(spark, sf)


_FLAG_NAMES = ("textLlm", "textRegex", "elementLlm", "elementRegex")


@query(
    "popup_coverage",
    "SELECT (SELECT count(*) FROM documents) AS files, "
    + ", ".join(f'count(*) FILTER ("{n}") AS "{n}", round(100.0 * count(*) FILTER ("{n}") / (SELECT count(*) FROM documents), 1) AS "{n}Pct"' for n in _FLAG_NAMES)
    + f" FROM ({O_FLAGS})",
)
def popup_coverage(spark, sf):
    out = det.popup_coverage(flags(spark, sf), b.scraped(spark, sf))
    for n in _FLAG_NAMES:
        out = out.withColumn(f"{n}Pct", F.col(f"{n}Pct").cast("double"))
    return out


@query("distinct_button_texts", f"SELECT DISTINCT CASE WHEN isreject THEN 'reject' ELSE 'other' END AS kind, text FROM ({O_LABELLED}) WHERE llmmatch")
def distinct_button_texts(spark, sf):
    return det.distinct_button_texts(labelled(spark, sf))


O_COUNTS = f"SELECT label AS button_text, count(DISTINCT page) AS occurences FROM ({O_LABELLED}) WHERE (regexmatch OR llmmatch) AND label <> '' GROUP BY label"


def counts(spark, sf):
    return det.button_occurrences(labelled(spark, sf))


@query("button_occurrences", O_COUNTS)
def button_occurrences(spark, sf):
    return counts(spark, sf)


# --- corpus ---------------------------------------------------------------------------------------------

# Labels of the corpus: the class, with a wrong label on every fifth length and none on every ninth.
O_CORPUS = f"""SELECT button_text, occurences, CASE WHEN length(button_text) % 9 = 0 THEN '' WHEN length(button_text) % 5 = 0 THEN {b.pick('length(button_text)', ('Accept', ' reject ', 'settings', 'bogus'))}
  ELSE {q.classified('button_text', P)} END AS label FROM ({O_COUNTS})"""


def corpus(spark, sf):
    n = F.length("button_text")
    wrong = F.element_at(F.array(*[F.lit(x) for x in ("Accept", " reject ", "settings", "bogus")]), (n % 4 + 1).cast("int"))
    label = F.when(n % 9 == 0, "").when(n % 5 == 0, wrong).otherwise(det.classify_label(F.col("button_text")))
    return counts(spark, sf).withColumn("label", label)


def results(spark, sf):
    return cp.predict(cp.corpus_prepare(corpus(spark, sf)))


O_PREPARED = f"""SELECT button_text, occurences, lower(trim(label)) AS label FROM ({O_CORPUS}) WHERE lower(trim(label)) IN ('settings', 'accept', 'reject', 'acknowledge', 'other')"""
O_RESULTS = f"SELECT *, {q.classified('button_text', P)} AS predicted FROM ({O_PREPARED})"


@query("corpus_prepare", O_PREPARED)
def corpus_prepare(spark, sf):
    return cp.corpus_prepare(corpus(spark, sf))


def _bench_sql() -> str:
    cols = []
    for p, v in (("row", "1"), ("weighted", "occurences")):
        t = lambda cond, v=v: f"CAST(coalesce(sum({v}) FILTER ({cond}), 0) AS BIGINT)"
        sup, cor, fp = t("label = target"), t("label = target AND predicted = target"), t("label <> target AND predicted = target")
        cols += [
            f'{sup} AS "{p}Support"', f'{cor} AS "{p}Correct"', f'{fp} AS "{p}FalsePositives"', f'{t("label = target AND predicted <> target")} AS "{p}Missed"',
            f'CAST({cor} AS DOUBLE) / nullif({sup}, 0) AS "{p}CorrectRate"', f'CAST({fp} AS DOUBLE) / nullif(CAST(sum({v}) AS BIGINT), 0) AS "{p}FalsePositiveRate"',
        ]
    return f"""SELECT target AS label, {', '.join(cols)} FROM (SELECT * FROM ({O_RESULTS}) WHERE label <> 'other') r,
      (VALUES ('settings'), ('accept'), ('reject'), ('acknowledge')) t(target) GROUP BY target"""


O_BENCH = _bench_sql()


@query("label_benchmark", O_BENCH)
def label_benchmark(spark, sf):
    return cp.label_benchmark(results(spark, sf))


@query(
    "benchmark_totals",
    "SELECT "
    + ", ".join(f'CAST(sum("{n}") AS BIGINT) AS "{n}"' for n in ("rowSupport", "weightedSupport", "rowCorrect", "weightedCorrect", "weightedFalsePositives", "weightedMissed"))
    + f""", CAST(sum("rowCorrect") AS DOUBLE) / sum("rowSupport") AS "rowCorrectRate", CAST(sum("weightedCorrect") AS DOUBLE) / sum("weightedSupport") AS "weightedCorrectRate"
    FROM ({O_BENCH}) WHERE "rowSupport" > 0""",
)
def benchmark_totals(spark, sf):
    return cp.benchmark_totals(label_benchmark(spark, sf))


@query(
    "benchmark_examples",
    f"""WITH r AS ({O_RESULTS}), c AS (SELECT *, predicted AS target, 'false_positive' AS kind FROM r WHERE label NOT IN ('other', predicted) AND predicted <> 'other'
    UNION ALL SELECT *, label, 'missed' FROM r WHERE label NOT IN ('other', predicted))
    SELECT * FROM (SELECT target, kind, button_text, label, predicted, occurences, CAST(row_number() OVER (PARTITION BY target, kind ORDER BY occurences DESC, button_text) AS INT) AS "rank" FROM c) WHERE "rank" <= 25""",
)
def benchmark_examples(spark, sf):
    return cp.benchmark_examples(materialize(results(spark, sf), "results"))


@query("label_counts", f"SELECT label, count(*) AS n FROM ({O_CORPUS}) WHERE label <> '' GROUP BY label")
def label_counts(spark, sf):
    return cp.label_counts(corpus(spark, sf))


@query("unlabelled", f"SELECT button_text, occurences FROM ({O_CORPUS}) WHERE label = ''")
def unlabelled(spark, sf):
    return cp.unlabelled(corpus(spark, sf)).select("button_text", "occurences")


@query(
    "quality_gate",
    f"""SELECT bool_and("rowFalsePositives" = 0) AS no_false_positives, bool_and("weightedCorrectRate" > 0.9) AS accurate,
    bool_and("rowFalsePositives" = 0 AND "weightedCorrectRate" > 0.9) AS passed FROM ({O_BENCH}) WHERE "rowSupport" > 0""",
)
def quality_gate(spark, sf):
    return cp.quality_gate(label_benchmark(spark, sf))


_NEW = f"SELECT label AS button_text, count(DISTINCT page) AS occurences FROM ({O_LABELLED}) WHERE label <> '' GROUP BY label"


@query(
    "merge_corpus",
    f"""SELECT button_text, coalesce(o.occurences, 0) + coalesce(n.occurences, 0) AS occurences, coalesce(o.label, '') AS label
    FROM ({O_CORPUS}) o FULL JOIN ({_NEW}) n USING (button_text)""",
)
def merge_corpus(spark, sf):
    every = buttons(spark, sf).select("page", tx.clean_button_text(F.col("text")).alias("button_text")).filter("button_text <> ''")
    new = every.distinct().groupBy("button_text").agg(F.count("*").alias("occurences"))
    return cp.merge_corpus(corpus(spark, sf), new)


O_AFTER = f"SELECT button_text, occurences, {q.classified('button_text', P)} AS label FROM ({O_COUNTS})"
O_CHANGES = f"SELECT button_text, a.occurences, o.label AS old_label, a.label AS new_label FROM ({O_CORPUS}) o JOIN ({O_AFTER}) a USING (button_text) WHERE o.label <> a.label"


def changes(spark, sf):
    after = counts(spark, sf).withColumn("label", det.classify_label(F.col("button_text")))
    return cp.label_changes(corpus(spark, sf), after)


@query("label_changes", O_CHANGES)
def label_changes(spark, sf):
    return changes(spark, sf)


@query("selection_confirm", f"SELECT * FROM ({O_CHANGES}) WHERE regexp_matches(button_text, '(?i)wybór|wybrane|selección|selecció|selection|selected')")
def selection_confirm(spark, sf):
    return cp.selection_changes(changes(spark, sf))


@query("score_texts", f"SELECT DISTINCT label AS text, length(label) > 12 AS verdict FROM (SELECT {_CLEAN} AS label FROM ({b.O_BUTTONS}))")
def score_texts(spark, sf):
    labels = buttons(spark, sf).select(tx.clean_button_text(F.col("text")).alias("label"))
    return registry.score_texts(labels, "label", lambda s: s.str.len() > 12, "boolean")


@query("verdict_store", f"SELECT label AS text, min(length(label) > 12) AS verdict FROM (SELECT {_CLEAN} AS label FROM ({b.O_BUTTONS})) GROUP BY label")
def verdict_store(spark, sf):
    labels = buttons(spark, sf).select("page", tx.clean_button_text(F.col("text")).alias("label"))
    store = shared_dir(spark, "verdicts")
    registry.judge_into_store(labels, "label", lambda s: s.str.len() > 12, store, "boolean")
    # The second run meets only known texts, so its judge, which says the opposite, changes nothing.
    return registry.judge_into_store(labels, "label", lambda s: s.str.len() <= 12, store, "boolean")


# --- consent rules ------------------------------------------------------------------------------------------

REGION = "GB"


def sites(spark, sf):
    return b.scraped(spark, sf).select(F.col("page").alias("file"), "initialUrl", "finalUrl")


def site_frames(spark, sf):
    return frames(spark, sf).withColumnRenamed("page", "file")


def reject_buttons(spark, sf):
    return labelled(spark, sf).filter("llmMatch AND isReject").select(F.col("page").alias("file"), *POS, "isTop", "origin", "text", "selector")


def site_cmps(spark, sf):
    name = b.pick("doc_id", ("auto_GB_x_1", "", "Known One", "  "))
    return b.spark_sql(spark, sf, f"SELECT doc_id AS file, {name} AS name FROM $documents")


_SITES = b.oracle(f"SELECT {b.D} AS file, {b.DOC_INITIAL} AS initialurl, {b.DOC_FINAL} AS finalurl FROM $documents")
_OCMPS = f"SELECT doc_id AS file, {b.pick('doc_id', ('auto_GB_x_1', '', 'Known One', '  '))} AS name FROM documents"
_OBUTTONS = f"SELECT page AS file, frame, popup, button, istop, origin, text, selector FROM ({O_LABELLED}) WHERE llmmatch AND isreject"
_MATCH = f"""SELECT DISTINCT s.file, r.name FROM ({_SITES}) s JOIN ({b.O_RULES}) r ON regexp_matches(s.initialurl, r.pattern) OR regexp_matches(s.finalurl, r.pattern)
  OR r.vendor IN (s.initialurl, s.finalurl) UNION SELECT DISTINCT f.page, r.name FROM ({b.O_FRAMES}) f JOIN ({b.O_RULES}) r ON r.inframe AND regexp_matches(f.origin, r.pattern)"""


def matches(spark, sf):
    return ru.match_rules(sites(spark, sf), b.rules(spark, sf), site_frames(spark, sf))


def groups(spark, sf):
    # Read several times by the decisions.
    site_groups, group_rules = ru.match_groups(sites(spark, sf), b.rules(spark, sf), site_frames(spark, sf))
    return materialize(site_groups, "site-groups"), materialize(group_rules, "group-rules")


@query("known_cmp", f"SELECT DISTINCT file FROM ({_OCMPS}) WHERE trim(name) <> '' AND NOT starts_with(trim(name), 'auto_')")
def known_cmp(spark, sf):
    return ru.known_cmp(site_cmps(spark, sf))


@query("match_rules", _MATCH)
def match_rules(spark, sf):
    return matches(spark, sf)


@query(
    "rule_has_button",
    f"""SELECT file, frame, popup, button FROM ({_OBUTTONS}) x WHERE EXISTS (SELECT 1 FROM ({_MATCH}) m JOIN ({b.O_RULES}) r USING (name) WHERE m.file = x.file AND r.selector = x.selector)""",
)
def rule_has_button(spark, sf):
    found = ru.rule_has_button(reject_buttons(spark, sf), groups(spark, sf))
    return _long(found).select("file", *POS)


_HOST = lambda u: f"regexp_extract({u}, '^[a-z]+://([^/?#:]+)', 1)"
_BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"
_CANDS = f"""SELECT x.*, s.initialurl, origin <> 'null' AS usable, regexp_replace({_HOST('origin')}, '^www[.]', '') AS framedomain,
  regexp_replace({_HOST('initialurl')}, '^www[.]', '') AS topdomain FROM ({_OBUTTONS}) x JOIN ({_SITES}) s USING (file)"""


@query("generalize_domain", f"SELECT page AS file, frame, regexp_replace({_HOST('origin')}, '^www[.]', '') AS domain, '^https?://(www\\.)?' || replace(regexp_replace({_HOST('origin')}, '^www[.]', ''), '.', '\\.') || '/' AS pattern FROM ({b.O_FRAMES}) WHERE origin <> 'null'")
def generalize_domain(spark, sf):
    f = _long(site_frames(spark, sf)).filter("origin <> 'null'")
    d = urls.generalize_domain(urls.url_host(F.col("origin")))
    return f.select("file", "frame", d.alias("domain"), urls.url_pattern(d).alias("pattern"))


@query("parse_rule_name", f"""SELECT name, nullif(regexp_extract(name, '^auto_([A-Z][A-Z])_(.+?)_(.+)$', 1), '') AS region, nullif(regexp_extract(name, '^auto_([A-Z][A-Z])_(.+?)_(.+)$', 2), '') AS domain,
    nullif(regexp_extract(name, '^auto_([A-Z][A-Z])_(.+?)_(.+)$', 3), '') AS suffix FROM ({b.O_RULES}) UNION ALL SELECT 'hand_3', NULL, NULL, NULL""")
def parse_rule_name(spark, sf):
    return b.rules(spark, sf).select("name", urls.parse_rule_name(F.col("name")).alias("p")).select("name", "p.*")


@query(
    "candidate_rules",
    f"""SELECT file, frame, popup, button, usable, framedomain AS "frameDomain", 'auto_GB_' || topdomain AS name_stem,
    '^https?://(www\\.)?' || replace(framedomain, '.', '\\.') || '/' AS "urlPattern", selector FROM ({_CANDS}) WHERE usable""",
)
def candidate_rules(spark, sf):
    c = ru.candidate_rules(reject_buttons(spark, sf), sites(spark, sf), REGION).filter("usable")
    stem = F.regexp_replace("name", "_[0-9a-z]{3}$", "")
    return _long(c).select("file", *POS, "usable", "frameDomain", stem.alias("name_stem"), "urlPattern", "selector")


_DEC = f"""mt AS ({_MATCH}), ru AS ({b.O_RULES}), md AS (SELECT mt.file, ru.*, CASE WHEN ru.name LIKE 'auto_%' AND (regexp_matches(s.initialurl, ru.pattern) OR regexp_matches(s.finalurl, ru.pattern))
  THEN regexp_extract(replace(ru.pattern, '\', ''), '^.*[?](.*)/$', 1) ELSE '~' || ru.name END AS grp FROM mt JOIN ru USING (name) JOIN (__SITES__) s ON s.file = mt.file),
cl AS (SELECT DISTINCT file, selector FROM md), st AS (SELECT file, count(*) AS matched, count(*) FILTER (region = 'GB') AS regional FROM md GROUP BY file),
c AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY frame, popup, button) AS pos FROM ({_CANDS})),
fp AS (SELECT *, min(pos) FILTER (usable) OVER (PARTITION BY file, selector) AS first FROM c),
kp AS (SELECT fp.*, coalesce(pos > first, FALSE) OR cl.file IS NOT NULL AS kept, coalesce(st.matched, 0) AS matched, coalesce(st.regional, 0) AS regional
  FROM fp LEFT JOIN cl USING (file, selector) LEFT JOIN st USING (file)),
nu AS (SELECT *, CASE WHEN NOT kept AND usable THEN sum(CASE WHEN NOT kept AND usable THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY pos) END AS k FROM kp),
sl AS (SELECT file, name AS existing, manual, row_number() OVER (PARTITION BY file ORDER BY grp, name) AS k FROM md WHERE region = 'GB'),
de AS (SELECT nu.*, existing, coalesce(sl.manual, FALSE) AS manual, CASE WHEN kept THEN 'kept' WHEN matched = 0 THEN 'new' WHEN existing IS NOT NULL THEN 'override'
  WHEN regional = 0 THEN 'new_region' ELSE 'new_extra' END AS decision FROM nu LEFT JOIN sl ON sl.file = nu.file AND sl.k = nu.k WHERE kept OR usable),
ow AS (SELECT framedomain, selector, min(file) AS owner FROM de WHERE decision LIKE 'new%' GROUP BY framedomain, selector),
rs AS (SELECT de.*, CASE WHEN decision LIKE 'new%' AND file <> owner THEN 'kept' ELSE decision END AS resolved FROM de LEFT JOIN ow USING (framedomain, selector))""".replace("__SITES__", _SITES)


def decisions(spark, sf):
    found = materialize(reject_buttons(spark, sf), "buttons")
    return ru.decide_rules(found, sites(spark, sf), groups(spark, sf), REGION)


def resolved(spark, sf):
    return materialize(ru.resolve_duplicates(decisions(spark, sf)), "decisions")


@query(
    "decide_rules",
    f'WITH {_DEC} SELECT file, frame, popup, button, selector, decision, existing, manual, matched, regional FROM de',
)
def decide_rules(spark, sf):
    d = _long(decisions(spark, sf))
    existing = F.when(F.col("decision") == "override", F.col("ruleName"))
    return d.select("file", *POS, "selector", "decision", existing.alias("existing"), "manual", "matched", "regional")


@query("resolve_duplicates", f"WITH {_DEC} SELECT file, frame, popup, button, resolved AS decision FROM rs")
def resolve_duplicates(spark, sf):
    return _long(ru.resolve_duplicates(decisions(spark, sf))).select("file", *POS, "decision")


def confirmed(spark, sf):
    """Confirmed popups per site, and the reject buttons of the first one."""
    lab = labelled(spark, sf).filter("llmMatch AND isReject").groupBy("page", "frame", "popup").agg(F.count("*").alias("n"))
    pops = classified_popups(spark, sf).filter("llmMatch").join(lab, det.POPUP_KEY, "left")
    first = F.min_by(F.coalesce("n", F.lit(0)), F.struct("frame", "popup"))
    return pops.groupBy(F.col("page").alias("file")).agg(F.count("*").alias("popups"), first.alias("rejectButtonsInFirst"))


_CONF = f"""SELECT page AS file, count(*) AS popups, arg_min(coalesce(n, 0), frame * 1000 + popup) AS infirst FROM (SELECT * FROM ({O_CPOPUPS}) WHERE llmmatch) p
  LEFT JOIN (SELECT page, frame, popup, count(*) AS n FROM ({O_LABELLED}) WHERE llmmatch AND isreject GROUP BY page, frame, popup) USING (page, frame, popup) GROUP BY page"""
_WWW = "regexp_replace({}, '^www[.]', '')"
_NOTES = f"""cf AS ({_CONF}), hs AS (SELECT cf.file, {_HOST('initialurl')} AS a, {_HOST('finalurl')} AS b FROM cf JOIN ({_SITES}) s USING (file)),
no AS (SELECT file, 'Multiple popups or reject buttons found' AS note, FALSE AS review FROM cf WHERE popups > 1 OR infirst > 1
 UNION ALL SELECT file, 'New rule added', FALSE FROM rs WHERE resolved = 'new'
 UNION ALL SELECT file, 'New region-specific popup', FALSE FROM rs WHERE resolved = 'new_region'
 UNION ALL SELECT file, CASE WHEN manual THEN 'Updated rule that has been manually edited before' ELSE 'Overriding existing rule' END, manual FROM rs WHERE resolved = 'override'
 UNION ALL SELECT file, 'Multiple existing rules with the same region found, consider removing all but one', TRUE FROM rs WHERE resolved IN ('override', 'new_extra') AND regional > 1
 UNION ALL SELECT file, 'Already overridden all existing rules, creating a new one', TRUE FROM rs WHERE resolved = 'new_extra'
 UNION ALL SELECT file, 'Multiple new rules generated', TRUE FROM rs WHERE resolved LIKE 'new%' GROUP BY file HAVING count(*) > 1
 UNION ALL SELECT file, 'Site changed host: `' || a || '` -> `' || b || '`', TRUE FROM hs WHERE a <> b AND a <> 'www.' || b AND b <> 'www.' || a)"""


def notes(spark, sf, done=None):
    return ru.review_notes(done or resolved(spark, sf), sites(spark, sf), confirmed(spark, sf))


@query("review_notes", f'WITH {_DEC}, {_NOTES} SELECT file, note, review AS "needsReview", count(*) AS n FROM no GROUP BY ALL')
def review_notes(spark, sf):
    return notes(spark, sf).groupBy("file", "note", "needsReview").agg(F.count("*").alias("n"))


@query(
    "site_manifest",
    f"""WITH {_DEC}, {_NOTES} SELECT s.file, s.finalurl AS "siteUrl", coalesce(mr, '') AS "matchedRules", coalesce(cf.popups, 0) AS popups, coalesce(nw, 0) AS "newRules",
    coalesce(up, '') AS "updatedRules", coalesce(nn, 0) AS notes FROM ({_SITES}) s
    JOIN (SELECT DISTINCT page AS file FROM ({b.O_FRAMES})) f USING (file)
    LEFT JOIN (SELECT file, string_agg(trim(name), '|') AS mr FROM ({_OCMPS}) WHERE trim(name) <> '' GROUP BY file) m USING (file) LEFT JOIN cf USING (file)
    LEFT JOIN (SELECT file, count(*) FILTER (resolved LIKE 'new%') AS nw, string_agg(existing, '|' ORDER BY existing) FILTER (resolved = 'override') AS up FROM rs GROUP BY file) d USING (file)
    LEFT JOIN (SELECT file, count(*) AS nn FROM no GROUP BY file) n USING (file)""",
)
def site_manifest(spark, sf):
    done = resolved(spark, sf)
    m = ru.site_manifest(
        sites(spark, sf), site_frames(spark, sf), site_cmps(spark, sf), classified_popups(spark, sf).withColumnRenamed("page", "file"),
        done, notes(spark, sf, done),
    )
    size = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("bigint")
    text = lambda c: F.coalesce(F.array_join(c, "|"), F.lit(""))
    return m.select(
        "file", "siteUrl", text("matchedRules").alias("matchedRules"), size("llmConfirmedPopups").alias("popups"),
        size("newlyCreatedRules").alias("newRules"), text("updatedRules").alias("updatedRules"), size("reviewNotes").alias("notes"),
    )


_KNOWN = f"(SELECT DISTINCT file FROM ({_OCMPS}) WHERE trim(name) <> '' AND NOT starts_with(trim(name), 'auto_'))"


@query(
    "rule_summary",
    f"""WITH {_DEC}, fr AS (SELECT DISTINCT page AS file FROM ({b.O_FRAMES})), cf AS ({_CONF}), kn AS {_KNOWN},
    z AS (SELECT d.doc_id AS file, fr.file IS NOT NULL AS f, kn.file IS NOT NULL AS k, cf.file IS NOT NULL AS c, n, u, kp FROM documents d LEFT JOIN fr ON fr.file = doc_id
      LEFT JOIN kn ON kn.file = doc_id LEFT JOIN cf ON cf.file = doc_id LEFT JOIN (SELECT file, count(*) FILTER (resolved LIKE 'new%') AS n,
      count(*) FILTER (resolved = 'override') AS u, count(*) FILTER (resolved = 'kept') AS kp FROM rs GROUP BY file) x ON x.file = doc_id)
    SELECT count(*) AS files, count(*) FILTER (f) AS "sitesWithPopups", count(*) FILTER (f AND (k OR c)) AS detected, count(*) FILTER (f AND k) AS handled,
      count(*) FILTER (f AND c AND NOT k) AS unhandled, CAST(sum(n) AS BIGINT) AS "newRules", count(*) FILTER (n > 0) AS "newSites", CAST(sum(kp) AS BIGINT) AS "keptRules",
      count(*) FILTER (kp > 0) AS "keptSites", CAST(sum(u) AS BIGINT) AS "updatedRules", count(*) FILTER (u > 0) AS "updatedSites" FROM z""",
)
def rule_summary(spark, sf):
    done = resolved(spark, sf)
    return ru.rule_summary(sites(spark, sf), site_frames(spark, sf), ru.known_cmp(site_cmps(spark, sf)), confirmed(spark, sf), done)

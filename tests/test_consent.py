"""Consent messages, popup detection and the button classifier."""

import pytest
from pyspark.sql import functions as F

from crawlprism.operators import consent as cs
from crawlprism.operators import corpus as cp
from crawlprism.operators import detection as det
from crawlprism.patterns import PatternSet, default_patterns

MSG = (
    "page string, seq bigint, type string, cmp string, result boolean, details string, heuristicPatterns array<string>, "
    "heuristicSnippets array<string>, url string, isMainFrame boolean, performance struct<filterCMPs:array<double>>"
)


def messages(spark, items, page="p"):
    names = [p.split()[0] for p in ("page", "seq", "type", "cmp", "result", "details", "heuristicPatterns", "heuristicSnippets", "url", "isMainFrame", "performance")]
    rows = [tuple({"page": page, "seq": n, **m}.get(k) for k in names) for n, m in enumerate(items)]
    return spark.createDataFrame(rows, MSG)


D = {"type": cs.DETECTED, "cmp": "A"}
FOUND = {"type": cs.FOUND, "cmp": "A"}
OUT = lambda ok: {"type": cs.OPT_OUT, "cmp": "A", "result": ok}
DONE = {"type": cs.DONE, "cmp": "A"}
TEST = lambda ok: {"type": cs.SELF_TEST, "cmp": "A", "result": ok}
# messages, action -> final, open, started, succeeded, selfTestFail
CASES = [
    ([D], "optOut", (False, False, False, False, False)),
    ([D, FOUND], None, (False, True, False, False, False)),
    ([D, FOUND, OUT(False)], "optOut", (False, True, True, False, False)),
    ([D, FOUND, OUT(True), DONE], "optOut", (True, True, True, True, False)),
    ([D, FOUND, OUT(True), DONE, TEST(True)], "optOut", (True, True, True, True, False)),
    ([D, FOUND, OUT(True), DONE, TEST(False)], "optOut", (True, True, True, True, True)),
    ([D, D, FOUND, OUT(False), OUT(True)], "optOut", (False, True, True, False, False)),
    ([D, FOUND, {"type": cs.OPT_IN, "cmp": "A", "result": True}], "optIn", (False, True, True, True, False)),
]


@pytest.mark.parametrize(("items", "action", "want"), CASES)
def test_cmp_results(spark, items, action, want):
    (r,) = cs.all_cmps(messages(spark, items), action).collect()
    assert (r.final, r.open, r.started, r.succeeded, r.selfTestFail) == want


def test_no_messages_no_row(spark):
    assert cs.all_cmps(messages(spark, [{"type": "init"}])).count() == 0


def test_heuristics_only(spark):
    report = {"type": cs.REPORT, "heuristicPatterns": ["a", "b"], "heuristicSnippets": ["s"]}
    nested = cs.nest_cmps(messages(spark, [report, {**report, "heuristicPatterns": ["b", "c"]}])).first().cmps
    assert len(nested) == 1
    assert (nested[0].name, nested[0].open, nested[0].patterns, nested[0].snippets) == ("", False, ["a", "b", "c"], ["s"])


def test_errors_reach_every_platform(spark):
    items = [D, {**D, "cmp": "B"}, {"type": cs.ERROR, "details": '{"x":1}'}, {"type": cs.ERROR, "details": '"y"'}]
    nested = cs.nest_cmps(messages(spark, items)).first().cmps
    assert [(c.name, c.errors) for c in nested] == [("A", ['{"x":1}', '"y"']), ("B", ['{"x":1}', '"y"'])]


def test_last_performance_report_wins(spark):
    perf = lambda url, v: {"type": cs.REPORT, "url": url, "isMainFrame": True, "performance": ([v],)}
    rows = cs.frame_performance(messages(spark, [perf("https://a.com/?1", 1.0), perf("https://a.com/#2", 2.0), perf("", 3.0)])).collect()
    assert [(r.frameUrl, r.performance.filterCMPs) for r in rows] == [("https://a.com/", [2.0])]


NOTICES = [
    "This website uses cookies to improve your experience.",
    "WE USE COOKIES",
    "By continuing to browse you agree to our use of cookies",
    "Nous utilisons des cookies.",
    "Wir verwenden Cookies, um Inhalte zu personalisieren.",
    "Deze site maakt gebruik van cookies",
    "Utilizamos cookies propias y de terceros",
    "Używamy plików cookie",
    "Мы используем файлы cookie",
    "Utilitzem galetes",
    "Store and/or access information on a device",
    "Alles ablehnen",
    "Tout refuser",
]
ORDINARY = [
    "",
    "Help Contact Pricing Jobs Cookie settings Privacy policy",
    "This site is for adults only. By pressing continue you confirm your age.",
    "Would you like to enable notifications?",
    "Our bakery has the best cookie in town",
    "wir sind für dich da",
]


def test_popup_text(spark):
    df = spark.createDataFrame([(t, True) for t in NOTICES] + [(t, False) for t in ORDINARY], "t string, want boolean")
    wrong = df.withColumn("got", det.popup_text_match(F.col("t"))).filter("got <> want").collect()
    assert wrong == []


def test_anchors_lose_nothing():
    """Every notice pattern must contain its anchor word in each of its alternatives."""
    for anchor, group in default_patterns().notices.items():
        for p in group:
            assert anchor in p, (anchor, p)


LABELS = {
    "reject": [
        "Reject all", "Decline", "No, thanks", "I do not accept", "Continue without accepting →", "Only necessary cookies", "Accept only essential cookies",
        "Strictly necessary", "Do not sell my personal information", "Opt-out of sale", "Disagree and close", "Weigeren", "Alles afwijzen",
        "Alleen noodzakelijke cookies", "Doorgaan zonder accepteren", "Nee, bedankt", "Tout refuser", "Continuer sans accepter", "Non, merci",
        "Uniquement les cookies nécessaires", "Alle ablehnen", "Nur notwendige Cookies", "Ohne Einwilligung fortfahren", "Nein, danke", "Rifiuta tutto",
        "Continua senza accettare", "Accetta solo necessari", "Rejeitar todos os cookies", "Aceitar apenas os cookies essenciais", "Rechazar todas",
        "Solo necesarias", "Denegar", "Avvisa alla", "Bara nödvändiga", "Rebutja-les totes", "Rexeitar", "Baztertu", "Odmítnout vše", "Odrzuć wszystkie",
        "Tylko niezbędne", "Nie zgadzam się", "Отклонить все", "Reddet", "Tolak cookie",
    ],
    "settings": [
        "Cookie settings", "Manage preferences", "Customize", "More options", "Let me choose", "Show details", "Privacy choices", "Voorkeuren aanpassen",
        "Instellingen", "Paramétrer les cookies", "Personnaliser", "Gérer mes préférences", "Einstellungen", "Cookie-Einstellungen", "Mehr Optionen",
        "Einstellungen verwalten", "Configurar cookies", "Preferencias", "Personalizar", "Dostosuj", "Ustawienia cookies", "Настройки", "Personalitza",
        "Konfiguratu", "Ayarlar", "Pokaż więcej opcji", "Zarządzaj plikami cookie", "Kelola preferensi",
    ],
    "accept": [
        "Accept all", "I agree", "Allow all cookies", "Accept selected", "Yes", "Agree and close", "Alle akzeptieren", "Zustimmen", "Ich stimme zu",
        "Auswahl bestätigen", "Accepteer alle cookies", "Akkoord", "Ja, ik ga akkoord", "Tout accepter", "J’accepte", "Accepter et continuer", "Aceptar todo",
        "Aceptar todas las cookies", "Sí, acepto", "Accetta tutti i cookie", "Aceitar todos", "Acceptera alla", "Accepta totes", "Onartu", "Souhlasím",
        "Zaakceptuj wszystkie", "Zgadzam się", "Принять все", "Kabul et", "Terima semua", "Save preferences", "Yes, allow all of them",
        "Uložit nastavení", "Simpan pilihan", "Guardar selección",
    ],
    "acknowledge": [
        "OK", "Got it", "Close", "Dismiss", "I understand", "Continue", "✕ Close", "Confirm my choices", "Close this banner", "Verstanden", "Schließen",
        "Sluiten", "Begrepen", "J'ai compris", "Fermer", "Entendido", "Cerrar", "Vale", "Rozumiem", "Zamknij", "Понятно", "x",
    ],
    "other": [
        "", "×", "Privacy Policy", "Cookie-Richtlinie", "Learn more", "Reject and pay", "Accept and subscribe", "Ablehnen und abonnieren", "Impressum",
        "Menu", "Sign in", "Search", "Cancel", "Powered by X", "Cookie policy", "Newsletter", "Pagar y rechazar", "Contact us",
    ],
}


def test_classifier_on_labelled_corpus(spark):
    """The quality bar: no label of the corpus may be confused, and over 90 % must be right by weight."""
    rows = [(t, 1 + len(ts) - n, label) for label, ts in LABELS.items() for n, t in enumerate(ts)]
    results = cp.predict(spark.createDataFrame(rows, "button_text string, occurences bigint, label string"))
    wrong = [(r.button_text, r.label, r.predicted) for r in results.filter("label <> predicted").collect()]
    assert wrong == []
    assert cp.quality_gate(cp.label_benchmark(results)).first().passed


def test_extra_rejects_and_replaceable_patterns(spark):
    df = spark.createDataFrame([("Powered by X",)], "t string")
    extra = default_patterns().with_extra_rejects(["powered by x", " "])
    assert df.select(det.is_reject_button(F.col("t"), extra)).first()[0]
    own = PatternSet.from_json('{"reject": [{"regex": "^powered", "unless": "by y"}, "exact one"], "notices": {"": ["abc"]}}')
    got = spark.createDataFrame([("powered by x",), ("powered by y",), ("Exact one",)], "t string").select(det.is_reject_button(F.col("t"), own))
    assert [r[0] for r in got.collect()] == [True, False, True]


def test_long_labels_are_other(spark):
    df = spark.createDataFrame([("a" * 201,), ("b",)], "text string")
    verdicts = spark.createDataFrame([("a" * 201, "accept"), ("b", "accept")], "text string, verdict string")
    assert {r.text[0]: r.llmClassification for r in det.judge_buttons(df, verdicts).collect()} == {"a": "other", "b": "accept"}


def test_hot_text_keeps_every_row(spark):
    """One label on a third of all rows: the verdict join neither loses nor multiplies rows."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "Accept").otherwise(F.concat(F.lit("b"), "id")).alias("text"), "id")
    verdicts = spark.createDataFrame([("accept", "accept")], "text string, verdict string")
    out = det.judge_buttons(df, verdicts)
    assert out.count() == 9000
    assert out.filter("llmClassification = 'accept'").count() == 3000


def test_popup_text_is_trimmed_and_empty_is_no_match(spark):
    popups = spark.createDataFrame([(1, 0, 0, "  "), (1, 0, 1, "  We use cookies ")], "page int, frame int, popup int, text string")
    verdicts = spark.createDataFrame([("", True), ("We use cookies", True)], "text string, verdict boolean")
    rows = det.classify_popups(popups, verdicts).orderBy("popup").collect()
    assert [(r.regexMatch, r.llmMatch) for r in rows] == [(False, False), (True, True)]


def test_merge_and_changes(spark):
    c = "button_text string, occurences bigint, label string"
    old = spark.createDataFrame([("a", 2, "accept"), ("b", 1, "")], c)
    new = spark.createDataFrame([("a", 3), ("z", 1)], "button_text string, occurences bigint")
    merged = {r.button_text: (r.occurences, r.label) for r in cp.merge_corpus(old, new).collect()}
    assert merged == {"a": (5, "accept"), "b": (1, ""), "z": (1, "")}
    after = spark.createDataFrame([("a", 2, "reject"), ("b", 1, "")], c)
    assert [tuple(r) for r in cp.label_changes(old, after).collect()] == [("a", 2, "accept", "reject")]


def test_benchmark_without_support_gives_nulls(spark):
    rows = spark.createDataFrame([("x", 4, "accept", "reject"), ("y", 1, "other", "accept")], "button_text string, occurences bigint, label string, predicted string")
    b = {r.label: r for r in cp.label_benchmark(rows).collect()}
    assert b["accept"].rowMissed == 1
    assert b["accept"].rowFalsePositives == 0
    assert b["reject"].weightedFalsePositives == 4
    assert b["reject"].rowCorrectRate is None
    assert b["reject"].rowFalsePositiveRate == 1.0

import random

import numpy as np
import pyarrow as pa
import pytest

from quillspark.llm import residue as rs

CONTENT = "The scheduler reads long prompts and the retry loop waits for them. After that the report is written to the table."


@pytest.mark.parametrize(("text", "slot"), [
    ("Hello {{name}}, welcome.", True), ("In ${city} we met.", True), ("By <%= author %> today", True), ("See __TEAM__ for more", True), ("Dear [Name], thank you", True), ("the (version TBD) of it", True), ("Use %CITY% now", True), ("to #{owner}.", True), ("for %(user)s it", True), ("Contact <YOUR_TEAM_HERE> soon", True), ("see {topic} here", True), ("at {%score%} again", True), ("by <user name> at", True), ("[insert date here]", True), ("欢迎来到{{city}},", True),
    ("The template writes `{{ name }}` for each turn.", False), ("```jinja\n{{ name }}\n```", False), ("{% for m in x %}{{ m.content }}{% endfor %}", False), ("so \\boxed{x} and \\frac{a}{b}", False), ("a set {1, 2} of numbers", False), ("use '{{ name }}' as shown", False), ("x[0] and [1] and [link](http://x)", False), ("costs $5 and $6", False), ('{"a": 1}', False), ("def f(x): return f'{x}'", False), ("<b>bold</b> <title>x</title>", False), ("", False), (CONTENT, False),
])
def test_slots(text, slot):
    assert rs.has_slot(text) is slot


PAGES = [
    "404 Not Found\nThe address you asked for does not exist on this server.\nTry again later.", "Home | Docs | Help\n\nAccess denied You lack the rights to view this resource. Ref: 0c7266dbb2", '{"error": {"code": 503, "message": "Our servers are busy right now."}, "request": "ab12cd34"}',
    "Please turn on JavaScript and load the page again.\n\n(c) Some Labs 2020", "<noscript>Without scripts this document stays blank.</noscript>", "PLEASE TURN ON JAVASCRIPT AND LOAD THE PAGE AGAIN.", "请在浏览器中打开脚本后重新加载。", "# About the judge\n\nLorem ipsum dolor sit amet consectetur. Dolor amet lorem ipsum.", "placeholder text, insert copy, your text here, some text",
    "Traceback (most recent call last):\n  File \"/srv/a.py\", line 3, in f\nRuntimeError: Something went wrong on our end.",
]
CLEAN = [
    CONTENT, "When a page is not found the search tool returns an empty list, and the model has to answer without it.", "A page that needs JavaScript is of no use to the fetch tool, so the crawler renders such pages first.", "Writers used filler such as 'lorem ipsum' in the first mock-up; the final guide replaced all of it.", "", None,
    "We looked into the 502 errors of last week: the server was restarted by hand, and 88 calls were lost on the way.", "Some users report that the error rate falls. " * 50, CONTENT * 3 + "\n404 Not Found",
]


def test_operator(spark):
    rows = [(i, t, "k", True) for i, t in enumerate(PAGES + CLEAN)]
    rows += [(0, PAGES[0], "k", True), (100, "Hello {{name}}.", "k", True), (101, PAGES[3], "k", True), (102, CONTENT * 20000, "k", True), (None, PAGES[1], "k", True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, message string, slot boolean")
    want = sorted([*map(str, range(len(PAGES))), "100", "101", "None"])
    assert sorted(str(r["doc_id"]) for r in rs.residue(df).collect()) == want
    assert sorted(str(r["doc_id"]) for r in rs.residue(df.repartition(7)).collect()) == want
    assert rs.residue(df.limit(0)).count() == 0


def mined(msgs, counts=None):
    """Verdicts of messages by number, through sorted runs as a task sees them."""
    rows = sorted((len(rs.mask(m)), " ".join(rs.mask(m)), i, rs.form(m), (counts or [1] * len(msgs))[i]) for i, m in enumerate(msgs))
    names = ["width", "tokens", "key", "form", "n"]
    out = [t for t in rs.mine_sorted(iter([pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))]))]
    return {r["key"]: r["verdict"] for t in out for r in t.to_pylist()}, {r["key"]: r["template"] for t in out for r in t.to_pylist()}


def test_templates_are_classified_once(monkeypatch):
    calls = []
    real = rs.judge_tokens
    monkeypatch.setattr(rs, "judge_tokens", lambda *a: calls.append(a) or real(*a))
    verdicts, templates = mined([f"Request {i} timed out after {i} tries on host alpha beta gamma{'x' * i}" for i in range(50)])
    assert len(calls) == 1 and len(set(templates.values())) == 1 and len(verdicts) == 50


def test_a_template_keeps_words_that_decide_apart():
    verdicts, templates = mined(["This page does not apply", "This page does not exist", "This page does not scroll"], [9, 5, 1])
    assert {k for k, v in verdicts.items() if v == "error"} == {1}
    assert templates[0] == templates[2] != templates[1]


def test_a_leaf_cut_in_parts_gives_the_same_verdicts(monkeypatch):
    msgs = ["Gateway timeout", "Access denied", "Unexpected error now in the plan of the day"] + [f"word other{i % 7} third{'y' * i}" for i in range(60)]
    whole, _ = mined(msgs)
    monkeypatch.setattr(rs, "LEAF", 8)
    assert mined(msgs)[0] == whole


@pytest.mark.parametrize("text", [
    "Error. Please try again later.", "Oops! Please reload the page.", "Not found", "Fehler. Bitte versuchen Sie es später erneut.", "Coming soon", "placeholder\n" * 9, "Gone.", "HTTP - 404", "No tiene permiso.", "asdf asdf qwer qwer",
    "ValueError: bad shape\nat run.Main(Main.java:3)", '  File "/srv/a.py", line 3, in f', "Lorem ipsum dolor sit amet, consectetur adipiscing elit", "Intro of the day\n<p>est non qui ipsum dolor sit</p>",
])
def test_messages_of_the_classes(text):
    assert any(rs.classify(m) in rs.RESIDUE for m in rs.messages(text))


def test_what_is_not_mined_has_no_verdict():
    texts = [CONTENT, *CHECKED, *HELD_OUT, *filter(None, PAGES + CLEAN)]
    own = [m for t in texts for m in rs.messages(t)]
    assert all(rs.form(m) or rs.may_decide(rs.mask(m)) for m in own if rs.classify(m) != "content")
    assert not all(rs.may_decide(rs.mask(m)) for m in own)


def is_page(text):
    bad = content = 0
    for m in rs.messages(text):
        verdict, n = rs.classify(m), len(rs.mask(m))
        bad, content = bad + n * (verdict in rs.RESIDUE), content + n * (verdict == "content")
    return bad > 0 and content <= bad


@pytest.mark.parametrize("text", [
    "The loop waits for the server and writes the report.", "Please open the file and read the first line.", "Set the limit to 40 and load the page again with the new filter.", "Error rates fall when the queue is short.", "The script reads the table and prints the sum.",
    "You need Python and a browser to run the notebook.", "The example shows how text is split into words.", "Replace the title with your own text.", "Der Server liest die Datei und schreibt den Bericht.", "Le serveur lit le fichier et écrit le rapport.", "El servidor lee el archivo y escribe el informe.",
    "服务器读取文件并写入报告。", "It is not what I look for.", "Thanks for your help, it works now.", "The access log shows which pages users open.", "Home is where the heart is.", "Some users report that the error rate falls, and some text is gone.", "See http://x/y for the 200 runs.", CONTENT,
])
def test_ordinary_sentences_are_content(text):
    assert not is_page(text)


# wordings that the vocabularies were checked with, and others that were not used for them
CHECKED = [
    "Turn JavaScript support on to use this dashboard.", "The resource is unreachable at the moment. Our engineers have been notified.", "We are sorry, this link has expired.", "Your session timed out. Please sign in again.", "Sorry, this content is no longer available.",
    "This website is offline for scheduled maintenance.", "Connection to the database failed.", "You are not authorized to open this folder.", "Proxy error: no response from upstream.", "The file you requested has been deleted.", "Rate limit exceeded.", "JavaScript must be active in your browser to load this application.",
    "This viewer does not work with scripts turned off.", "Placeholder for the summary.", "Insert body text here.", "Dummy paragraph", "Die Verbindung zum Server wurde unterbrochen.", "Diese Seite ist derzeit nicht erreichbar.", "Le service est temporairement indisponible.", "Ce lien a expiré.", "JavaScript doit être activé pour afficher cette page.",
    "El enlace ha caducado.", "El servicio no está disponible en este momento.", "Habilite JavaScript para usar esta aplicación.", "该链接已过期。", "服务器繁忙,请稍后再试。", "此应用需要启用JavaScript。", "此处输入标题",
]
HELD_OUT = [
    "This document could not be displayed.", "Sorry! Our site is having technical problems right now.", "You do not have access to this workspace.", "Connection lost. Reconnect and try again.", "The requested operation timed out.", "Unexpected response from the server.", "The image you are looking for was removed by its owner.",
    "Security check failed.", "Please activate JavaScript in order to use the shop.", "This map needs scripts; switch them on.", "Dummy title. Dummy text. Dummy text.", "Heading placeholder", "Zugriff nicht erlaubt.", "Der Dienst antwortet nicht. Versuchen Sie es in einigen Minuten noch einmal.", "Aktivieren Sie Skripte, um die Karte zu sehen.",
    "La page que vous cherchez a été supprimée.", "Accès non autorisé", "Activez les scripts de votre navigateur.", "Página en mantenimiento", "Su solicitud no pudo ser procesada.", "Este sitio funciona solo con JavaScript.", "系统正在维护,请稍后访问。", "对不起,您访问的文件已被删除。", "浏览器未开启脚本,页面无法显示。",
]


def test_wordings():
    assert all(map(is_page, CHECKED))
    assert sum(map(is_page, HELD_OUT)) >= 13


def test_common_phrases_alone_are_found(spark):
    texts = ["Error. Please try again later.", "placeholder\n" * 9, "Not found", CONTENT + " The error is gone."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in rs.residue(df).collect()) == [0, 1, 2]


def test_repeated_messages_count_as_often_as_they_stand(spark):
    one = "The scheduler reads long prompts and the retry loop waits for them."
    texts = ["Lorem ipsum dolor sit amet. " * 50 + one, "placeholder text.\n" * 50 + one, "placeholder text.\n" + (one + "\n") * 50, "## Placeholder notes of the day\n" * 50 + "placeholder text.", "the loop waits for them\n" * 50 + "placeholder text."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in rs.residue(df).collect()) == [0, 1, 3]


def test_what_the_corpus_says(spark):
    odd = "The otters sing of marmalade boats."  # no concept covers it, but it only stands on error pages
    latin = ["Lorem vunda keris ipsum morta", "Keris dolor vunda morta amet", "Morta keris lorem vunda", "Vunda amet keris morta", "Keris vunda morta", "Morta vunda keris vunda"]
    texts = [f"Service unavailable. The server is down. {odd}"] * 3 + [f"{CONTENT} {odd[:-1]} {i}." for i in range(2)] + latin + [CONTENT, CONTENT + "!", "Internal server error. " + "The walrus hums of cellars."]
    texts += ["Access denied. The otters sing of marmalade."] + [f"{CONTENT} The otters sing of marmalade." for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"] for r in rs.residue(df).collect()}
    assert got >= {0, 1, 2} | set(range(5, 11))
    assert not got & {3, 4, 11, 12, 13, *range(15, 35)}


def test_letters_typed_at_random():
    rng = random.Random(1)
    typed = [" ".join("".join(rng.choices("asdfjklqwert", k=rng.randint(2, 7))) for _ in range(20)) for _ in range(20)]
    for model in (rs.Letters([]), rs.Letters([CONTENT] * 20)):
        assert sum(map(model.random, typed)) >= 18
        assert not any(map(model.random, [CONTENT, "Kluwe Strzelczyk Nguyen Oyelaran Brzezinski", "def pebble_cache(xs, k=97) onyx tap", "", "El servidor lee el archivo y escribe", "szybko przeczytaj cały dokument teraz proszę"]))


def test_the_letters_of_all_documents_are_counted(spark):
    rng = random.Random(4)
    names = ["krzwt", "vlptk", "zdrkw", "ptkvz", "wkrzd", "tkvlp", "drkwz", "lptkv"]  # a language of the corpus that stands behind the first 4,096 characters
    say = lambda k: f"{' '.join(rng.choice(names) for _ in range(k))}.".capitalize()
    texts = [CONTENT * 40 + "\n" + "\n".join(say(12) for _ in range(90)) for _ in range(40)] + [CONTENT, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert rs.residue(df).count() == 0
    model, one = rs.letters_of(df.repartition(3), "text"), say(12)
    assert np.array_equal(model.log, rs.Letters(texts).log) and rs.Letters([CONTENT] * 40).random(one) and not model.random(one)


def test_counts_of_letters():
    texts = ["", "1 - 2", "a", "Don't stop: it's 5 o'clock!", "naïve Straße 漢字 abc", CONTENT]
    for t in texts:
        assert rs._text_codes(t).tolist()[1:-1] == rs._codes(rs._LETTERS.findall(t.lower())).tolist()[1:-1]
    assert rs.count_letters(texts).sum() == sum(max(0, len(rs._text_codes(t)) - 2) for t in texts) * rs._UNIT
    rng = random.Random(1)
    typed = [" ".join("".join(rng.choices("asdfjklqwert", k=rng.randint(2, 7))) for _ in range(20)) for _ in range(1000)]
    whole = rs.count_letters(["\n".join(typed)]).sum() / rs._UNIT
    assert whole == pytest.approx(rs.DOCUMENT_WEIGHT, rel=0.01)  # a long document counts whole, but weighs no more than others


def test_menus_are_no_content():
    cut = rs.cut("Home | Docs | Help\n\nSearch\nLog in\nRuns\n\nOne line here\nIt is a sentence. And one more.")
    assert [m for m, menu in cut if menu] == ["Home", "Docs", "Help", "Search", "Log in", "Runs"]
    assert [m for m, menu in rs.cut("a1, b2, c3\n# x, y, z") if menu] == ["a1", "b2", "c3"]

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import pairs as pr

Q = "A shop called Mer buys tiles at 19 cents and sells them at 40 cents. What is the gain on 11 tiles, in cents?"
DE = "Erkläre kurz, wie der Filter arbeitet und warum die Wartezeit schwankt."
ES = "Tell me how the trainer delays span records. Reply in Spanish."


@pytest.mark.parametrize(("prompt", "response", "want"), [
    (Q, None, "empty"), (Q, "", "empty"), (Q, " \n​", "empty"), (Q, "**Answer:** ", "empty"), (Q, "None", "empty"), (Q, "(no output)", "empty"), (Q, "\\boxed{}", "empty"), (Q, "<|im_end|>", "empty"), (Q, "<think>It is 3.</think>\n", "empty"),
    (Q, "I'm sorry, but I can't help with that.", "refusal"), (Q, "I CANNOT GO INTO THIS TOPIC.", "refusal"), (DE, "Leider kann ich diese Frage nicht beantworten.", "refusal"), (Q, "<think>Hm.</think>\nI must turn this down. I hope you understand.", "refusal"),
    (Q, Q, "copy"), (Q, f'[{{"role": "user", "content": "{Q}"}}]', "copy"), (Q, "> " + Q.lower(), "copy"), (Q, Q.replace("gain", "gian") + "</s>", "copy"),
    (Q, "Der Filter prüft die Daten und die Wartezeit bleibt gleich.", "other_language"), (DE, "The filter waits for the data and it is not stable.", "other_language"), (ES, "We saw that the trainer waits for the span records.", "other_language"), (Q, "Так как модель читает длинные запросы, время не меняется.", "other_language"),
    (Q, "Each sale brings 21 cents and the ga", "truncated"), (Q, "```python\nprint(1", "truncated"), (Q, "The result is $\\boxed{", "truncated"), (Q, "<think>Each sale brings", "truncated"), (Q, "| a | b |\n| --- | --- |\n| 1 |", "truncated"), (Q, "1. It works.\n2. The", "truncated"), (Q, "For example:", "truncated"), (Q, 'So {"answer": "', "truncated"),
    (Q, "231", None), (Q, "Answer: 231", None), (Q, "It is 231.", None), (Q, "$\\boxed{231}$", None), ("If it rains? (A) stay (B) go", "(B) go", None), ("Who built it?", "Nortu Wexnel", None), (Q, "1. each sale brings 21\n2. over 11 tiles that is 231", None),
    (Q, f"You asked: {Q}\n\nEach sale brings 21 cents, so the gain is 231 cents in all.", None), (Q, Q + " It is 231.", None), (ES, "La plantilla separa los valores y la demanda oscila en el servidor.", None), (DE, "Der Filter prüft die Daten, und die Wartezeit bleibt gleich.", None),
    (Q, "The log line \"I'm sorry, I cannot help with that\" comes from the safety stub, not from the engine.", None), (Q, "I can't give an exact figure for your setup, but the cause is known. The gain is the sum of all sales.", None), (Q, "no no no " * 30 + "done.", None), (None, "It is fine.", None),
])
def test_defects(prompt, response, want):
    assert pr.defect(prompt, response) == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=25), st.lists(st.sampled_from("abcd"), max_size=25))
def test_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    assert pr.lcs(a, b)[0] == row[-1]


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=80), st.text(max_size=80))
def test_any_text_has_a_verdict(prompt, response):
    assert pr.defect(prompt, response) in (None, "empty", "refusal", "copy", "other_language", "truncated")


def test_operator(spark):
    rows = [(1, Q, None, "completed"), (1, Q, None, "completed"), (2, Q, "", "pending"), (3, Q, "It is 231.", "failed"), (4, Q, Q, None), (5, Q, "word " * 100000 + "end.", "truncated"), (None, Q, "", "completed"), (6, None, "", "aborted")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "sample_index long, prompt string, response string, status string, defect string")
    got = sorted((str(r[0]), r[1]) for r in pr.broken_pairs(df).collect())
    assert got == [("1", "empty"), ("4", "copy"), ("None", "empty")]
    assert pr.broken_pairs(df.limit(0)).count() == 0


SHORT = "Why does the retry loop wait before it reads the next span record?"
OPTIONS = "Which of the four parts keeps the running sum of all the waiting times in the log? (A) the early reader of the long table (B) the late writer of the short table"


@pytest.mark.parametrize(("prompt", "response", "want"), [
    (Q, f"{Q}\n{Q}", "copy"), (Q, f"{Q} " * 50, "copy"), (SHORT, f"{SHORT} {SHORT}", "copy"), (SHORT, f"{SHORT} {SHORT} {SHORT}", "copy"), (Q, f"user: {Q}\nassistant: {Q}\nuser: {Q}", "copy"), (Q, (Q.replace("gain", "gian") + " ") * 3, "copy"),
    (OPTIONS, "(A) the early reader of the long table (B) the late writer of the short table Which of the four parts keeps the running sum of all the waiting times in the log?", "copy"),
    (Q, f"{Q} {Q} It is 231.", None), (Q, f"{Q} It is 231. {Q}", None), (Q, f"{Q} {Q} 231.", None), (OPTIONS, f"{OPTIONS} {OPTIONS} B.", None), (Q, f"{Q} " * 50 + "Each sale brings 21 cents.", None), (Q, f"{Q} 231 {Q} 231.", None),
])
def test_questions_given_back_repeatedly_or_in_another_order(prompt, response, want):
    assert pr.defect(prompt, response) == want


NO, KIND = "I'm sorry, but I can't help with that. ", "Thank you for your understanding. I hope you understand. "


@pytest.mark.parametrize(("response", "want"), [
    (NO * 50, "refusal"), (NO + KIND * 20, "refusal"), (NO + "\u200b" * 700, "refusal"), (" " * 700 + NO, "refusal"), (NO + KIND * 20 + "It is 231.", None), (NO + "The gain is the sum of all sales, as each of them brings the same. " * 20, None), (("The filter waits for the data and it is stable. " * 40) + NO, None),
])
def test_long_refusals(response, want):
    assert pr.defect(Q, response) == want


# wordings that were not used for the concepts and templates
UNSEEN = [
    "Regrettably this is not a subject on which I am willing to comment.", "I am not in a position to help here.", "That is a topic I would prefer to stay away from.", "My instructions do not let me talk about this.",
    "I can't engage with this request.", "I'd prefer not to say.", "Sorry, no comment from me on that.", "This question goes beyond what I can discuss.", "I'm afraid I can't do that.",
    "I won't be able to assist you with this.", "Unfortunately, I don't have permission to answer questions of this kind.", "It would not be right for me to respond.", "Please understand that I have to refuse.",
    "We do not provide help with such matters.", "I shall not reply to this.", "I must abstain from giving an answer.", "Answering that would go against my principles.", "Ich möchte mich dazu nicht äußern.",
    "Es ist mir nicht gestattet, darüber zu sprechen.", "Hierzu gebe ich keine Auskunft.", "Tut mir leid, dabei kann ich Ihnen nicht weiterhelfen.", "Ich lehne diese Anfrage ab.", "Je préfère ne pas répondre.",
    "Il m'est impossible de traiter cette demande.", "Je ne suis pas autorisé à parler de ce sujet.", "Désolé, je décline cette requête.", "Prefiero no hablar de este asunto.", "No estoy autorizado a responder.",
    "Lo siento, me abstengo de opinar.", "No me es posible atender esta petición.", "抱歉,我没办法回答这类问题。", "这个请求我不能满足。", "我不方便谈论这个主题。", "很遗憾,我拒绝回答。",
]
ORDINARY = [
    "I can't be sure, but the gain is large.", "It does not rain there.", "The filter does not read the table.", "No, it is not allowed to cross the bridge.", "We cannot divide by zero, so x is not zero.",
    "I would say the river lies to the north.", "Nobody knows who built it.", "The rule does not apply to short prompts.", "Es gibt keinen Unterschied zwischen den beiden.", "Il n'y a pas de différence.",
    "No hay ninguna diferencia entre los dos.", "没有区别。", "You should not answer before the search tool returns.", "The limit is not reached.", "He refused to sell the mill.", "The council declined the offer.",
    "It can not exceed the limit of the queue.", "The model can not keep up.", "You may not use this option.",
]


def test_refusals_in_unseen_wordings():
    assert sum(map(pr.is_refusal, UNSEEN)) >= 0.9 * len(UNSEEN)
    assert not any(map(pr.is_refusal, ORDINARY))


def test_remarks_beside_refusals():
    assert pr.is_refusal("I cannot answer that. The choir of Merdas is a delicate matter.", "Who leads the choir of Merdas?")
    assert not pr.is_refusal("I cannot answer that. The choir is led by Ossnel Vora.", "Who leads the choir of Merdas?")
    long = "I'm sorry. " + "I cannot help with that. " * 30
    assert pr.is_refusal(long) and len(long) > 600


def test_standing_instructions(spark):
    from quillspark.llm.common import instruction_pattern, standing_instructions

    rows = [(f"Say it in one word. How many {i} are there?",) for i in range(6)] + [(f"How many {i} are there? Who keeps them? SAY it  in one word.",) for i in range(6, 12)]
    rows += [(f"What is {i}? How is it kept?",) for i in range(20)] + [(None,), ("",)] + [("One prompt. Often repeated.",)] * 100
    df = spark.createDataFrame(rows, "text string")
    got = standing_instructions(df)
    assert got == ["say it in one word."]
    assert pr.question_tokens(rows[7][0], instruction_pattern(got)) == "how many 7 are there who keeps them".split()
    assert standing_instructions(df.limit(0)) == []


@pytest.mark.parametrize(("response", "want"), [
    ("Filtr czyta dane i nie jest to szybkie, ale można go użyć przed pętlą.", "other_language"), ("Bu filtre veri için çok önemli ve daha hızlı, ama her zaman değil.", "other_language"), ("Filtret läser data och det är inte snabbt, men kan vara bra för alla.", "other_language"),
    ("Il filtro legge i dati e non è veloce, ma può essere usato anche per questo.", "other_language"), ("word " * 500 + "end.", None),
])
def test_more_languages(response, want):
    assert pr.defect(Q, response) == want

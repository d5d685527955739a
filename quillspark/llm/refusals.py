"""Refusals as abstract templates: who (does not) want, may or can say something, per language.

A sentence is turned into the sequence of the concepts of its words and aligned with templates of concepts; no sentence is listed.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import regex

# ---- fixed values: concepts by language. I who speaks, J a verb that says it of the speaker, X cannot and will not, n negation, M being able, allowed or willing, V acts of speech and help, D declining, Q what was asked, L rules and limits, K keeping from, C courtesies and advice. A stem stands for every word that begins with it; $ ends a whole word
CONCEPTS = {
    "en": {
        "I": "i$ im$ id$ ill$ ive$ me$ my$ myself we$ our$ us$ assistant model ai$", "X": "cannot cant$ couldnt$ wont$ wouldnt$ unable shouldnt$ mustnt$ unwilling", "n": "not$ no$ never$ nothing neither nor$ none$ dont$ doesnt$ isnt$ arent$ without",
        "M": "able$ allowed permi can$ could$ may$ might$ will$ would$ want$ wish willing comfort rather$ prefer position possib going$ supposed free$ prepared inclined liberty able$ must$ have$ something",
        "V": "help assist answer respon reply replies replying comment discuss provid compl fulfil say$ saying speak share talk tell$ give$ giving given$ engage address$ explain support go$ get$ weigh do$ offer produc generat continu express opin elaborat",
        "D": "declin refus reject pass$ turn$ abstain refrain withhold skip$ avoid stay$", "Q": "this$ that$ it$ these$ question request topic subject matter issue prompt query such$ kind$ here$ one$ into$ area",
        "L": "guideline polic rule$ rules$ scope outside beyond limit restrict prohibit forbid bounds against ethic principle falls$ sensitive", "K": "keep prevent stop$ stops$ bar$ bars$",
        "C": "sorry apolog unfortunate regret afraid thank$ thanks$ please understand hope let$ know$ feel$ like$ try$ another other different else$ happy glad respect however yet$ expert professional qualified specialist consult suggest recommend seek person honest fair training knowledge access information context advice appreciat patience ask$ asking instead usage little$ more$ there$ after$ some$ thought within kind$ want$",
    },
    "de": {
        "I": "ich$ mir$ mich$ mein wir$ uns$", "X": "$$", "n": "nicht$ kein nichts$ nie$ niemals", "M": "kann$ könn darf$ dürf möcht will$ werde$ werden$ lage$ erlaub gestatt befugt bereit möglich lieber muss$ müss imstande",
        "V": "helf antwort beantwort sag äußer unterstütz eingeh gebe$ geben$ mitteil sprech red$ reden diskut erteil weiterhelf liefer nachkomm besprech bearbeit stellung auskunft", "D": "ablehn verweiger weiger absag passen$ enthalt lehne$ abzulehn",
        "Q": "das$ dies frage$ fragen$ thema anfrage dabei$ dazu$ darauf$ hierzu hierbei damit$ solche anliegen darüber hierüber", "L": "richtlinie regel außerhalb rahmen grenze verbot untersagt vorgab", "K": "hinder",
        "C": "leider entschuldig tut$ leid$ bitte$ danke$ verständnis hoffe$ fachkraft fachperson expert wenden ander stellen stell$ frag gern bedaur bedauer verzeih sonst lieber",
    },
    "fr": {
        "I": "je$ j$ me$ m$ moi$ mon$ ma$ mes$ nous$", "X": "$$", "n": "ne$ n$ pas$ rien$ aucun jamais", "M": "peux$ puis$ pouv peut$ veux$ voul souhait mesure droit autoris permis$ permet dois$ doit$ devo vais$ préfère possible capab suis$",
        "V": "aid répon dire$ parl discut comment fourni donner$ donne$ trait abord assist exprim satisf", "D": "refus déclin abstien absten", "Q": "cette$ ce$ cela$ ceci$ question demande$ sujet thème requête y$ là$ dessus",
        "L": "interdit règle directive limit hors$ dépass politique cadre", "K": "empêch",
        "C": "malheureusement navré désolé pardon regret excus merci$ compréhension pose posez poser autre expert spécialiste consult demandez plutôt mieux saura veuillez espèr professionnel",
    },
    "es": {
        "I": "yo$ me$ mi$ mí$ nos$", "J": "puedo debo quiero deseo podré estoy tengo podemos prefiero voy$ responderé daré hablaré", "X": "$$", "n": "no$ ningun ningún nada$ tampoco",
        "M": "permitid posible capaz dispuest autorizad", "V": "ayud respond contest dar$ habl coment decir$ proporcion trat discut opin cumpl complac ofrec", "D": "rechaz negar niego declin abst rehús", "Q": "eso$ esto$ este$ esta$ ello$ pregunta tema solicitud petición cuestión asunto",
        "L": "permitid prohibid norma regla política límit fuera", "K": "impid", "C": "siento lamento lamentable perdón perdone desgracia haga hagan otra$ otro$ gracias comprensión consult mejor especialista expert favor disculp espero profesional",
    },
    "ru": {
        "I": "я$ мне$ мо мы$ нам$", "X": "нельзя", "n": "не$ нет$ ничего", "M": "мог может можем буду$ хоч вправе готов должен вынужден", "V": "отвеч ответ помо обсужд сказ говор предостав коммент", "D": "отказ отклон воздерж",
        "Q": "этот$ это$ эту$ этом$ этим$ вопрос тем просьб запрос", "L": "запрещ правил политик рамк", "K": "мешают", "C": "извин сожален прост задайте друг спасиб понима надеюсь обратит специалист пожалуйста",
    },
    "zh": {
        "I": "我 本人 作为", "X": "无法 不能 不会 不便 不可 没办法 不允许 不予 不愿 不想 不方便 恕难", "V": "回答 帮助 提供 满足 讨论 谈论 回复 协助 谈 解答 处理 评论 透露 说明 回应 帮", "D": "拒绝 婉拒 谢绝", "Q": "这个 这 问题 请求 话题 内容 方面 此 该 要求 主题 您",
        "L": "超出 范围 规定 准则 政策 允许 限制 的 我的", "M": "必须 只能", "n": "不", "K": "禁止", "C": "对不起 抱歉 很 不好意思 请 换 一个 感谢 您的 您 理解 谢谢 谅解 建议 咨询 专业 人士 遗憾 希望 能 见谅 其他 别的 助手 再 你 到 ,",
    },
}
# ---- fixed values: templates; each is a sequence of concepts with anything between
TEMPLATES = {
    "en": "I X V|X V Q|I X M V|I n M V|I n M Q|I M n V|I D|D Q|Q I L|Q L I|Q L M|Q L V|L K V|L K I|n V M|n V I|V n I M|Q n I M|n M V Q|I n V Q|I M D|X V I|I X Q",
    "de": "M I n V|I M n V|I D|Q D|D I|I V n|V I n|n M V|Q M n V|Q I L|Q L I|Q L M|Q L V|M Q n V|I n M V|I n V M",
    "fr": "I n M V|I n V|I M D|I D|Q I L|Q L I|Q L M|Q L V|n M V|I n M|Q n M V", "es": "n J V|n J M V|n V Q|J D|I D|Q n M|n L|Q I L|Q L I|Q L M|Q L V|n M V|I n L|Q n L|J n V|J V n", "ru": "I n M V|I n V|M D|I D|Q X|X V|X Q|I Q n|Q I L|Q L I|Q L M|Q L V|Q n V|n M V", "zh": "I X V|X V Q|Q X V|D Q|I D|I M D|Q I X|L L|X V|I n V",
}
#: Least share of a sentence's words, function words aside, that must belong to concepts.
COVER = 0.7
# ---- fixed values: words that stand between the concepts
FREE = {
    "en": "hm well oh um ah a an the to of with for on in by at be am is are was and or but so as any an from about what which you your how should keep to than too very just because it's its do does did been there also only or and",
    "de": "der die das den dem ein eine einer einen zu zum zur auf mit bei für und oder aber dass auch so als ihr ihre ihnen sie es in im von diese dieser dieses diesem ist sind bin am besten eine",
    "fr": "le la les l un une des de du d à au et ou mais que qu vous votre vos en sur est ai avoir être pour dans c s qui avec un suis",
    "es": "el la los las un una de del a al y o pero que le les su con por en es ha he lo se muy usted", "ru": "в на с и по к что вам вы ваш а но за из ответить как",
    "zh": "的 了 吧 呢 , 。",
}
_MAPS = {k: {s: c for c, v in own.items() for s in reversed(v.split())} for k, own in CONCEPTS.items()}
for _k, _own in CONCEPTS.items():  # the first concept of a stem holds
    for _c in reversed("IJXnMVDQLKC"):
        _MAPS[_k].update({s: _c for s in _own.get(_c, "").split()})
_FREE = {k: frozenset(v.split()) for k, v in FREE.items()}
_PATTERNS = {k: [t.split() for t in v.split("|")] for k, v in TEMPLATES.items()}
_LANGS = [k for k in CONCEPTS if k != "zh"]
_HAN_TERM = regex.compile("|".join(sorted(_MAPS["zh"], key=lambda s: (-len(s), s))))
_HAN = regex.compile(r"\p{Han}")
_ELISION = regex.compile(r"\b(l|d|j|m|n|s|c|t|qu)['’](?=\p{L})")
_WORD = regex.compile(r"[\p{L}\p{M}]+|\p{N}+")
@lru_cache(maxsize=50_000)
def _concept(lang: str, word: str) -> str:
    own = _MAPS[lang]
    found = own.get(word + "$") or next((own[word[:n]] for n in range(len(word), 1, -1) if word[:n] in own), "")
    return found or ("-" if word in _FREE[lang] else "?")


def aligned(template: list[str], concepts: str) -> bool:
    """All of the template stands in the sequence, in order: its longest common subsequence with the sequence is the template."""
    at = -1
    for c in template:
        at = concepts.find(c, at + 1)
        if at < 0:
            return False
    return True


def _verdict(lang: str, kinds: str) -> str:
    own = [c for c in kinds if c != "-"]
    if not own or sum(c != "?" for c in own) < COVER * len(own):
        return ""
    if any(aligned(t, kinds) for t in _PATTERNS[lang]):
        return "refusal"
    return "courtesy" if "C" in own else ""


@lru_cache(maxsize=4096)
def judge(sentence: str) -> tuple[str, int]:
    """``refusal``, ``courtesy``, ``remark`` or ``none``, and the number of words."""
    text = unicodedata.normalize("NFKC", sentence).lower()
    if _HAN.search(text):
        terms = [m if isinstance(m, str) else m[0] for m in _HAN_TERM.findall(text)]
        kinds = "".join(_MAPS["zh"][t] * 1 for t in terms)
        size = len(_HAN.findall(text))
        covered = sum(len(_HAN.findall(t)) for t in terms) + sum(text.count(x) for x in "了吧呢的")
        if not size:
            return "none", 0
        if covered < COVER * size:
            return "remark", size
        return ("refusal" if any(aligned(t, kinds) for t in _PATTERNS["zh"]) else "courtesy" if "C" in kinds else "remark"), size
    text = _ELISION.sub(r"\1 ", text).replace("’", "'").replace("'", "")
    words = _WORD.findall(text)
    if not words:
        return "none", 0
    best, rows = "remark", [_concepts[w] for w in words]
    for i, lang in enumerate(_LANGS):
        kinds = "".join([r[i] for r in rows])
        n = len(words) - kinds.count("-")
        if n == 0 or n - kinds.count("?") < COVER * n:
            continue
        got = _verdict(lang, kinds)
        if got == "refusal":
            return got, len(words)
        best = got or best
    return best, len(words)


class _Concepts(dict):
    """A word's concept in every alphabetic language; kept for the words seen last."""

    def __missing__(self, word: str) -> str:
        if len(self) > 100_000:
            self.clear()
        self[word] = out = "".join(_concept(lang, word) for lang in _LANGS)
        return out


_concepts = _Concepts()


@lru_cache(maxsize=100_000)
def _may(word: str) -> bool:
    return any(c in "XnDLK" for c in _concepts[word])


def may_refuse(words: list[str], text: str) -> bool:
    """No refusal is without a negation, a word of declining or a limit; ``words`` are the text's."""
    return any(map(_may, set(words))) or not text.isascii() and any(_MAPS["zh"][m] in "XnDLK" for m in _HAN_TERM.findall(text))

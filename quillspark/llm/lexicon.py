"""Small vocabularies by concept: what messages of servers, script notices and filler are made of, in six languages; and the commonest words of more.

No sentence is listed. A message is judged by how much of it these concepts cover and which of them it holds, so that wordings need not
be known. A stem stands for every word that begins with it; ``$`` ends a whole word.
"""

from __future__ import annotations

from functools import lru_cache

import regex

# ---- fixed values: words without content of their own, by language
FUNCTION = {
    "en": "a an the of and or to is are was were be been being it its this that these those there here in on at by for from with as if so but we you i he she they them our your my their us me him her what which who when where why how has have had do does did will would can could should may might must than then too very just only also some any all each both such into out up about over",
    "de": "der die das den dem des ein eine einer einem einen und oder ist sind war waren wird werden wurde es sie er wir ihr ich in im an am auf für von vom zu zum zur mit bei beim als wenn dass daher auch nur noch sich ihnen ihre ihren diese dieser dieses etwas man hat haben hier da so aus nach um",
    "fr": "le la les l un une des de du d et ou est sont était été être il elle nous vous je on à au aux en dans pour par sur avec ce cette ces que qu qui se s votre vos notre nos ici y a si mais donc comme ne n avez avons ont ai as eu peut doit être actuellement moment momentanément lors",
    "es": "el la los las un una de del y o es son era fue ser se en a al por para con que lo su sus este esta esto estos le les ha hay he nos usted si pero como más está están puede pudo debe momento estamos",
    "ru": "и в на с по к у за из от о для что это как вы мы он она они ваш наш этот эта эту эти при",
}
# ---- fixed values: the commonest words of more languages, by which a language is told
FUNCTION_WORDS = {
    "en": """the of and to is in that it for on with as are this was be by at from or an not have but they you which when if will can all so there what one has its how than then while because before after does
 only we our no each why where who whose do did i my me him her his their them could would should may might just into over under out up down more most some any such nor too very both a been were these those write give tell explain""".split(),
    "de": """der die das und ist nicht den dem ein eine einer einen sich auf mit für von zu im als auch wird werden wenn dass wir sie es ich aber nach bei aus am ob nur noch durch wie kann sind oder man sobald weil
 danach dagegen bleibt was warum wann wo wer dann denn doch schon sehr mehr ihr ihre sein seine unter über vor beim zum zur vom hat haben war wurden soll sollte muss müssen geschieht dabei damit ohne jede jeder eines des daher erkläre kurz in bis""".split(),
    "fr": """le la les des et est une un du dans que qui pour pas sur avec au aux ce cette ne se plus par sont il elle nous vous je mais ou si comme dès sans après avant car leur était être sous chaque pourquoi entre on
 ensuite cas en quand comment afin lorsque dont où tout tous toute cela ces son sa ses leurs nos votre vos mon ma mes qu lui fait peut doit bref contraire passe à vu durant près""".split(),
    "es": """el los las y es una un del que para no por con se su como más pero al lo si porque cuando entre sin desde hasta este esta son ha muy ya también donde dónde qué cada antes luego tras sobre está vimos conviene
 durante mientras en la de cómo cuándo después entonces tiene puede pueden hay ni o sus les nos era estos estas esa ese aquí así tan poco mucho toda todo todos a breve explica ocurre cambio""".split(),
    "it": "il lo gli della che di per non con una sono nel alla più anche come ma se quando perché dei delle questo questa è e i le un in da si ha ho del dal dalla sul sulla nella nelle degli al ai cui dove prima dopo ogni essere stato stata tutto tutti molto mentre quindi però solo ancora già così quale loro suo sua".split(),
    "pt": "o os uma não com para por mais como mas ao dos das que em se quando porque foi são está também ele ela e a um de do da na no nas nos pelo pela pelos pelas isso este esta esse essa seu sua seus suas já muito ainda depois antes então sem sobre entre até ser ter tem há onde cada todo toda todos assim você".split(),
    "nl": "het een van niet dat zijn voor met maar ook als bij naar wordt deze dit de en in op te is die er om aan uit dan nog wel geen heeft hebben worden werd was waren kan kunnen moet moeten zal zou door over onder tussen na toen wanneer waar wat wie hoe waarom ik je jij hij zij wij jullie hun haar onze elke alle meer".split(),
    "pl": "i w na z do nie że się jest to jak ale o po od za przez dla są był była było być ten ta te tego tej tym które który która oraz lub czy gdy kiedy jeśli tak już tylko może można więc przed pod nad bez ich jego jej co gdzie dlaczego każdy bardzo".split(),
    "cs": "a v na z do ne že se je to jak ale o po od za pro jsou byl byla bylo být ten ta tento tato které který která nebo když pokud tak už jen může více před pod nad bez jejich jeho její co kde proč každý velmi aby mezi při".split(),
    "tr": "ve bir bu da de için ile çok daha olarak gibi ama ne var yok olan kadar sonra önce her o şu mi mı değil ise ya veya çünkü eğer nasıl neden hangi kendi ben sen biz siz onlar tüm bazı göre üzerinde".split(),
    "sv": "och i att det som en på är av för med den till inte om ett har de var från vid eller när kan men ska så också efter bara där hur varför vad vilken vi ni han hon jag sig utan mellan under över varje mycket än".split(),
    "da": "og i at det som en på er af for med den til ikke om et har de var fra ved eller når kan men skal så også efter kun der hvor hvordan hvorfor hvad vi han hun jeg sig uden mellem under over hver meget end blev bliver".split(),
    "fi": "ja on ei että se oli hän mutta kun niin myös ovat tai jos kuin sen joka jotka tämä tässä mitä missä miksi miten vain ennen jälkeen ole olla voi kaikki hyvin enemmän sekä kanssa sitten jo vielä".split(),
    "hu": "a az és hogy nem is egy ez van volt de meg csak mint ha vagy már még el ki mert amely amit aki akkor után előtt között minden nagyon több lehet kell hogyan miért hol mi ők ezt azt".split(),
    "ro": "și în de la cu pe nu că este un o din pentru mai ce care sunt fost dar sau dacă când după înainte prin între foarte fără ale lui ei lor acest această fi avea poate cum unde fiecare tot".split(),
    "id": "yang dan di ke dari ini itu untuk dengan tidak pada adalah akan atau juga dalam oleh sebagai karena jika ketika sudah bisa dapat lebih saya kami kita mereka anda apa bagaimana mengapa setiap semua setelah sebelum antara".split(),
    "vi": "và của là có không được cho với các những một trong này đã để khi thì như nhưng từ ở vào ra đến nếu hoặc vì sao nào mỗi rất hơn cũng sau trước tại bởi".split(),
}
# ---- fixed values: concepts. T things of the web, F failure, f negation and other weak signs of it, A what one does with a page, H help and advice, R requiring, P filler, p weak signs of filler, N parts of a text
CONCEPTS = {
    "en": {
        "T": "page site website content$ rate$ profile account country region password username email server resource document file$ files$ address url link request connection gateway host backend upstream service app$ application browser session account permission right$ rights access quota record$ database network system login article video image photo item message item dashboard viewer portal domain proxy certificate endpoint folder directory client http https",
        "F": "error fail fault crash broke wrong unavailab unreachab inaccessib denied deny refus forbidden unauthori prohibit missing gone$ expired timeout timed$ busy overload down$ offline exceed exhaust outage maintenance moved$ removed$ deleted$ suspend restrict disconnect corrupt dead$ discontinued decommissioned hiccup snag lack$ lacks$ unable oops whoops exception malfunction mistyped",
        "f": "not$ no$ nothing cannot can't couldn't doesn't didn't isn't wasn't won't never unexpected bad$ internal temporar unknown closed$ reset$ lost$ old$ quota invalid limit interrupt too$ many$ long$ longer$ yet$ hit$ unsupported incomplete never suspend stopped$",
        "A": "load open view display show shown render find found$ exist availab accessib reach process complet handl fetch get$ reply respond response look ask serve start stop stopped use$ used$ enter type perform connect happen occur appear visit receiv took$ take$ download upload save play$ edit verify submit follow current momentar early went$ gave$ give$ given$ something$ closed made$ try$",
        "H": "try$ again$ later retry reload refresh check spelling contact support admin webmaster help home$ homepage back$ go$ return please report notif team$ engineer staff apolog sorry inconvenien reference code$ minute moment soon$ shortly wait problem persist keep keeps$ tell write quote below hour issue technical difficult thank patience search instead box$ number end$ side$ sign$ attempt once contacting resolve fix$ working$ know$",
        "R": "support need requir comment see$ interface feature modern compatible enabl turn$ turned$ switch allow activat disabl on$ off$ block without must support setting work run$ runs$ continu blank appear seem seems$ drawn$ board$",
        "P": "placeholder dummy filler blah xxx tbd tba todo insert coming lipsum", "p": "sample example your$ here$ goes$ soon$ replace add$ added$ adding written$ fill$ enter type$ follow follows$  more$ some$ to$",
        "N": "text copy content paragraph title heading block word description body caption section sentence summary subtitle",
    },
    "de": {
        "T": "seite webseite internetseite anmeldung login profil passwort bild video artikel adresse server dienst anfrage verbindung datei ressource dokument link zugriff berechtigung recht$ rechte sitzung konto browser anwendung datenbank netzwerk system gateway",
        "F": "fehler serverfehler fehlgeschlagen verweigert verboten abgelaufen unterbrochen überlastet ausgefallen störung wartung zeitüberschreitung unerreichbar schiefgelaufen fehlt$ fehlen gelöscht verschoben abgebrochen gesperrt ungültig abgelehnt ausfall überschritten unzulässig panne",
        "f": "nicht$ kein leider unerwartet intern vorübergehend",
        "A": "gefunden finden laden geladen öffnen anzeigen angezeigt verfügbar erreichbar antwort existier gibt$ aufgetreten trat$ auftret gewünscht angefordert aufgeruf gesucht verarbeit bearbeit besucht aufrufen hergestellt hier$",
        "H": "bitte$ später erneut versuch prüfen schreibweise zurück startseite neu$ kontakt administrator hilfe support minuten entschuldig wenden problem melden anmelden erneut geduld später zurückkehren",
        "R": "schalten$ ein$ an$ unterstütz verwend nutz brauch benötig erforder aktivier einschalt eingeschalt abgeschalt ausgeschalt deaktivier ohne$ leer$ bleibt erlaub zulass blockier nichts$ sehen ansicht einstellung daher$ damit$",
        "P": "platzhalter mustertext blindtext fülltext beispieltext", "p": "hier$ steht folgt folgen kommt bald einfügen beispiel", "N": "text inhalt titel überschrift absatz beschreibung",
    },
    "fr": {
        "T": "page site serveur contenu$ profil vidéo image article mot identifiant base données ressource document fichier adresse lien requête connexion service accès droit autorisation session compte navigateur application système passerelle",
        "F": "erreur échec échou panne introuvable indisponible inaccessible refus interdit expir dépass délai surcharg maintenance supprim déplac interromp invalide incident suspendu corrompu saturé coupé",
        "f": "pas$ autorisé autorisée aucun inattendu interne impossible temporairement", "A": "trouv charg affich ouvr répond exist disponible accessible demand survenu produit traiter atteindre accéd voir arrêt cherch requis",
        "H": "veuillez merci$ réessay plus$ tard$ recharg vérif orthographe retour accueil contact administrateur aide équipe minutes excus",
        "R": "requis requise support prise charge exige nécessit besoin activ désactiv bloqu sans$ autoris puis$ rien$ peut affiché fonctionn",
        "P": "provisoire factice remplissage", "p": "insér votre$ ici$ venir exemple compléter remplacer faux$", "N": "texte contenu titre paragraphe description",
    },
    "es": {
        "T": "página sitio contenido$ perfil vídeo imagen artículo contraseña base$ datos$ servidor recurso documento archivo dirección enlace solicitud conexión servicio acceso permiso derecho sesión cuenta navegador aplicación sistema",
        "F": "error fallo fallado expirad suspendid rechazad bloquead caíd roto denegad prohibid caduc agotad sobrecarg mantenimiento eliminad interrump inválid indisponib",
        "f": "no$ ningun sin$ inesperad interno imposible temporal", "A": "encontr conect carg mostrar muestr abrir respond respuesta exist disponible solicitad pedid producido ocurrid proces acceder ver$ verla verlo aquí hubo buscad tiempo tiene$",
        "H": "por$ favor intent inténtelo tarde$ nuevo$ vuelv volver inicio recarg revis ortografía contact administrador ayuda minutos disculp",
        "R": "admite compatible soporta necesit requier activ desactiv bloque sin$ habilit permit nada$ muestra cargar",
        "P": "relleno provisional próximamente", "p": "prueba insertar su$ aquí pendiente ejemplo escribir", "N": "texto contenido título párrafo descripción",
    },
    "ru": {
        "T": "страниц сервер адрес запрос сервис доступ сайт ресурс соединен браузер", "F": "ошибк недоступ запрещ истек превыш сбой", "f": "не$ нет$ временно", "A": "найден существует загруз отвеча открыть",
        "H": "пожалуйста повтор позже попробуйте обновите", "R": "включ требуется отключ необходим без$", "P": "заполнитель", "p": "здесь пример", "N": "текст содержание заголовок",
    },
    "zh": {
        "T": "页面 网页 网站 应用 程序 服务器 服务 地址 资源 文件 链接 请求 连接 权限 网关 浏览器 系统 网络 访问 本站 会话 账号 账户 登录 登陆 密码 视频 图片 文章",
        "F": "错误 不存在 失败 出错 无法 不可用 拒绝 禁止 超时 未找到 找不到 过期 故障 维护 异常 没有权限 没有响应 无响应 已删除 已移动 繁忙 中断", "f": "没有 暂时 不能 未", "A": "打开 加载 显示 查看 响应 发生 返回 处理 您 您的 当前 内容", "-": "了 的 是 在 该 此 时 到 也 和 与 被 会 中 于 地 后 本 上", "S": "脚本",
        "H": "请 稍后 重试 再试 刷新 重新 首页 检查 正确 是否 联系 管理员 帮助 客服 分钟 抱歉 或",
        "R": "运行 使用 启用 激活 开启 打开 需要 禁用 关闭 必须 支持 允许 才能", "P": "占位 待补充 待填写 敬请期待 即将上线", "p": "示例 测试 此处 这里 填写 请 在 输入 为", "N": "文本 文字 正文 标题 内容 段落 符",
    },
}
#: Names of scripts.
SCRIPT = regex.compile(r"javascripts?|ecmascript|js|scripts?|scripting|client-side|skripte|скрипт\p{L}*|脚本")
#: The usual passage of pseudo-Latin filler.
LATIN = frozenset("lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum".split())
#: Its words that no other language uses much: they mark a passage as filler.
LATIN_MARKS = frozenset("lorem ipsum dolor amet consectetur adipiscing eiusmod incididunt aliqua veniam nostrud ullamco aliquip reprehenderit cillum excepteur occaecat cupidatat proident deserunt laborum".split())
#: Rows of a keyboard.
KEY_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop", "yxcvbnm", "azertyuiop", "qsdfghjklm")
ALPHABETIC = tuple(FUNCTION)
_ELISION = regex.compile(r"^[a-z]{1,2}['’]")
_FUNCTION = {k: frozenset(v.split()) for k, v in FUNCTION.items()}
#: Common words of three letters or more, of any language: text has some of them, random letters hardly any.
COMMON = frozenset(w for v in FUNCTION_WORDS.values() for w in v if len(w) > 2) | frozenset(w for v in _FUNCTION.values() for w in v if len(w) > 2)
_STEMS = {k: {stem: c for c, v in own.items() for stem in reversed(v.split())} for k, own in CONCEPTS.items()}
# a stem of two concepts stands for both
_CLASSES = {k: {stem: "".join(c for c, v in own.items() if stem in v.split()) for stem in _STEMS[k]} for k, own in CONCEPTS.items()}
_HAN = regex.compile("|".join(sorted(_CLASSES["zh"], key=lambda s: (-len(s), s))))


@lru_cache(maxsize=100_000)
def concepts(word: str) -> tuple[str, ...]:
    """The word's concepts in each alphabetic language: letters of ``CONCEPTS``, ``S`` for scripts, ``-`` for a function word, else nothing."""
    if SCRIPT.fullmatch(word):
        return ("S",) * len(ALPHABETIC)
    out = []
    for lang in ALPHABETIC:
        own, found = _CLASSES[lang], ""
        bare = _ELISION.sub("", word) if lang == "fr" else word.replace("’", "'")
        found = own.get(bare + "$", "") or "".join(own[bare[:n]] for n in range(3, len(bare) + 1) if bare[:n] in own)
        out.append(found + "-" if bare in _FUNCTION[lang] else found)
    return tuple(out)


def han_concepts(message: str) -> list[tuple[str, int]]:
    """Concepts of Chinese terms and the characters each covers."""
    return [(_CLASSES["zh"][m], len(m)) for m in _HAN.findall(message)]


@lru_cache(maxsize=100_000)
def is_key_run(word: str) -> bool:
    """Keys beside each other on one row, or one key again and again."""
    return len(word) >= 4 and (len(set(word)) == 1 or any(word in row or word[::-1] in row for row in KEY_ROWS))


_BIT = {c: 1 << k for k, c in enumerate("TFfAHRPpNS-")}
#: Words of the usual filler and runs of keys.
MARK = 1 << 62


class _Bits(dict):
    """A word's concepts in all alphabetic languages as one number, eleven bits each; kept for the words seen last."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        out = MARK if word in LATIN_MARKS or is_key_run(word) else 0
        for i, kinds in enumerate(concepts(word)):
            for c in kinds:
                out |= _BIT[c] << 11 * i
        self[word] = out
        return out


BITS = _Bits()


def decisive(found: list[int], share: float) -> bool:
    """Whether words with these bits can have a verdict: one language must know ``share`` of them, with certain concepts among them."""
    whole = 0
    for b in found:
        whole |= b
    if whole & MARK:
        return True
    for i in range(len(ALPHABETIC)):
        b = whole >> 11 * i & 0x7FF
        if b & 64 or b & 2 or b & 16 or b & 512 and b & 32 or b & 128 and b & 256 or b & 4 and b & 9:
            mine = 0x7FF << 11 * i
            if sum(1 for x in found if x & mine) >= share * len(found):
                return True
    return False

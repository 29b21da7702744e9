"""Sentences of the readable text of e-mails, in any of their languages and scripts.

A mail is read down to its plain-text parts, those to blocks (runs of non-blank lines of one quote
depth), and each block, its lines joined, is run through a pushdown automaton. The automaton moves from
mark to mark: openers and closers of quotations and brackets push and pop, end marks of any script end
a sentence unless the word before them is in the abbreviation trie or the mark is part of a number, a
name or an unfinished quotation, and white space ends one where a script has no marks. Lists have levels
of their own: an item number at the start of a line that continues an open list, or begins one, opens a
sentence, and its dot ends none. Only marks and line starts are visited, so the cost follows their number.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- fixed values -------------------------------------------------------------------------------
#: Abbreviations after which a sentence goes on, whatever follows: titles, places, references.
ALWAYS = """
Mr Mrs Ms Dr Prof St Mt Rev Hon Capt Col Gen Lt Sgt Messrs Hr Fr Sr Sra Srta Dra Dña Mme Mlle Mgr Ud Uds Vd
P.S N.B approx ca cf vs e.g i.e viz resp bzw d.h z.B u.a z.T vgl Abb Nr Tel Fax ext fig Fig figs sec Sec ch vol Vol ver pp
pág págs aprox núm art Art Bd Str usf Sq Ave Blvd Rd al incl excl evtl ggf inkl zzgl gegr geb Kap Ziff
Mio Mrd Tsd Jh ders dgl ebd eigtl ggü jmd lfd mind möbl sog südl tgl u.U u.ä z.Hd bijv d.w.z m.b.t i.v.m t.a.v t.n.v
pagg cfr tfno cía dpto izq dcha dhr mevr mw drs éd attn assn eds
ул д кв пр пер просп обл г-н г-жа т.е т.к т.н т.д напр см стр рис гл им проф акад доц
डॉ श्री प्रो د أ م ص ت น พ ม ร ส ดร
""".split()
#: Titles and the like, written with a capital only.
TITLES = """
Gov Sen Rep Pres Maj Adm Cmdr Amb Atty Supt Insp Msgr Ste Ing Dipl Frl Abg Hrsg Dott Avv Geom Arch Sig Sigg Spett Egr
Lic Arq Exc Excmo Ilmo Mlles Mmes Apt Bldg Dept Mtn Hwy Fwy
""".split()
#: Abbreviations after which a sentence may also end, if what follows looks like a beginning.
MAYBE = """
Inc Corp Ltd Co Cos GmbH AG S.A S.L S.r.l N.V B.V LLC Plc plc a.m p.m A.M P.M U.K U.S U.S.A E.U Ph.D M.D B.A M.A Jr
etc usw т.п руб коп др год гг вв min hrs hr km kg
Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec Mon Tue Tues Wed Thu Thur Thurs Fri Sat Sun Mo Di Mi Do Sa So
""".split()
#: Abbreviations that only stand before a number.
BEFORE_NUMBER = "blz Blz pag Pag Cap chap Chap Rm Kap kap Abb abb Rn Abs Lfg No no Nos nos p pp Nr nr núm pág art Art fig Fig sec Sec ver vol ext Jan Feb Mar Apr May Jun Jul Aug Sep Sept Oct Nov Dec".split()
#: Words a German ordinal (5. Oktober, 2. Stock) stands before.
ORDINAL = """
Januar Februar März April Mai Juni Juli August September Oktober November Dezember Jänner Stock Etage Quartal
Tag Woche Monat Jahr Jahrhundert Klasse Platz Mal Auflage Kapitel Teil Weltkrieg
""".split()
#: Short words without a vowel that are no abbreviations: sounds, and shorthand that may end a sentence.
NO_ABBREVIATION = "hm hmm mm mmm sh shh shhh pst psst tsk brr grr pff pfft thx pls plz tks brb btw nth pc tv dvd cd pdf".split()
#: Lower-case beginnings: names of one small letter before a capital, and the word that answers start with.
LOWER_START = re.compile(r"(?:[a-z][A-Z][A-Za-z]+|ok\b)")
#: What goes on after a quotation that ended in an end mark, in scripts without capitals or spaces.
CJK_GOES_ON = re.compile(
    r"[とがをはもにでのへや]|って|など|という|然\s?后|接\s?着|随\s?后|于\s?是|并|而|就|便|又|才|但|"
    r"[^。！？!?“”「」]{0,14}?(?:[问说喊答写笑叫]\s?道|回\s?答|问|说|道)\s?(?=[。，,！]|$)"
)
SPOKE = re.compile(r"\S+(?: \S+)? (?:ने \S+(?:ा|ी|े|ीं)(?=[।,.!?]|$)|(?:asked|said|wrote|replied)(?=[.,;:]|$))")
#: End marks of the scripts of the world.
MARKS = ".!?…‥。！？｡．؟۔।॥՞՜։፧።᠃᠉‼⁇⁈⁉⁉︕︖"
PAIRS = {"(": ")", "[": "]", "{": "}", "（": "）", "［": "］", "「": "」", "『": "』", "【": "】", "《": "》", "〈": "〉", "«": "»", "“": "”", "„": "“", "‹": "›", "｢": "｣"}
#: UTF-8 read as a single-byte code page, as damaged mails have it.
DAMAGED = {"â€ž": "„", "â€œ": "“", "â€\x9d": "”", "â€�": "”", "Â«": "«", "Â»": "»", "â€¦": "…", "Â¿": "¿", "Â¡": "¡"}
EMOJI = "[\U0001f000-\U0001faff☀-➿⬀-⯿⌀-⏿]"
# -------------------------------------------------------------------------------------------------

CLOSERS = "".join(sorted(set(PAIRS.values()))) + '"'
CJK = re.compile(r"[぀-ヿ㐀-䶿一-鿿豈-﫿가-힯]")
THAI = "[฀-๿]"

EVENT = re.compile(
    r"(?P<skip>https?://[^\s<>\"“”«»（）()]*[^\s<>\"“”«»（）().,;:!?。，！？]|(?<![\w.+-])[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,})"  # looked for once per word, however long
    rf"|(?P<emoji>{EMOJI}(?:[️‍\U0001f3fb-\U0001f3ff]|{EMOJI})*)"
    r"|(?P<damaged>" + "|".join(map(re.escape, DAMAGED)) + ")"
    r"|(?P<open>[" + re.escape("".join(PAIRS)) + "])"
    r"|(?P<close>[" + re.escape(CLOSERS) + "])"
    rf"|(?P<end>[{re.escape(MARKS)}](?:[  ]?[{re.escape(MARKS)}])*)"
    rf"|(?P<thai>(?<={THAI}) +(?={THAI}))"
)
ITEM = re.compile(r"(\(?)([0-9]{1,3}(?:\.[0-9]{1,3})*|[a-zA-Z]|[ivxIVX]{1,4})([.)])(?=\s)")
ROMAN = {tens + ones: 10 * t + o for t, tens in enumerate(("", "x", "xx", "xxx")) for o, ones in enumerate(("", "i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix"))}
LEVELS = 64  # list levels kept open at most, the innermost ones
SPACES = re.compile(r"\s*")


def _forms(word: str) -> list[str]:
    """A word as it is, with accents apart, and as damaged mails have it."""
    return sorted({word, unicodedata.normalize("NFD", word), word.encode().decode("latin-1"), word.encode().decode("cp1252", "replace")})


class Trie:
    """Abbreviations, read backwards from the mark."""

    def __init__(self, words: list[str]) -> None:
        self.root: dict = {}
        for word in words:
            for form in _forms(word):
                node = self.root
                for letter in reversed(form):
                    node = node.setdefault(letter, {})
                node[""] = True

    def before(self, text: str, at: int, start: int) -> bool:
        """Whether one of the words stands before ``at`` as a whole word, its inner dots spaced or not."""
        node, i = self.root, at - 1
        found = False
        while True:
            if "" in node and (i < start or not (text[i].isalnum() or text[i] in "-'’") or (text[i + 1].isascii() and CJK.match(text[i]))):
                found = True
            if i < start:
                return found
            letter = text[i]
            if letter == " " and "." in node and i > start and text[i - 1] == ".":
                i -= 1
                letter = "."
            if letter not in node:
                return found
            node = node[letter]
            i -= 1


# a title or number may open a clause that begins in lower case
ORDINALS = re.compile("(?:" + "|".join(re.escape(f) for w in ORDINAL for f in _forms(w)) + r")(?!\w)")
TRIES = Trie([*ALWAYS, *TITLES, *(w[0].lower() + w[1:] for w in ALWAYS), *(w[0].upper() + w[1:] for w in ALWAYS if not w[0].isascii())]), Trie(MAYBE), Trie([*BEFORE_NUMBER, *(w.lower() for w in BEFORE_NUMBER)])


def _begins(text: str, at: int) -> bool:
    """Whether the text at ``at`` looks like the beginning of a sentence in a script with capitals."""
    rest = text[at : at + 12]
    if not rest:
        return True
    first = rest[0]
    if first in "\"“„«‹「『¿¡([（" or first.isdigit() or first.isupper() or first.istitle():
        return True
    if rest.startswith(tuple(DAMAGED)):
        return True
    return bool(LOWER_START.match(rest)) or (first.isalpha() and not first.islower())


def _full_stop(text: str, start: int, at: int, end: int, nxt: int) -> bool:
    """Whether the single dot at ``at`` ends the sentence begun at ``start``; ``nxt`` is the next non-space."""
    glued = nxt == end
    before = text[at - 1] if at > start else " "
    following = text[nxt : nxt + 1]
    if not following:
        return True
    if glued:
        # inside numbers, names of files, addresses; else a space is missing after the mark
        if following.isdigit() or following in ",;:-/)]}_@&'’":
            return False
        if following.isalpha() and not CJK.match(following) and not CJK.match(before):
            if following.islower():
                return bool(LOWER_START.match(text, nxt)) and before.isalnum()
            second = text[nxt + 1 : nxt + 2]
            more = text.find(".", nxt, nxt + 5)  # a dot within an abbreviation of several parts (z.Hd.)
            if more > 0 and " " not in text[nxt:more] and not text[max(start, at - 3) : at].strip(" (")[1:].isalpha() and TRIES[0].before(text, more, start) and not TRIES[0].before(text, more, nxt):
                return False
            if second == "." or not before.isalnum():
                return False  # letters of one abbreviation (U.K.)
            if following.isupper() and not (second.islower() or second == " " or second == "'"):
                return before.islower() and second.isalpha() and len(text[start:at].split(" ")[-1]) > 2 and second.isupper()
            if TRIES[0].before(text, at, start) and not TRIES[1].before(text, at, start):
                return False
            return not (before.isupper() and (at - 2 < start or not text[at - 2].isalnum()))
    if following in "&+/=":
        return False
    always, maybe, number = TRIES
    begins = _begins(text, nxt)
    if maybe.before(text, at, start):
        if number.before(text, at, start) and following.isdigit():
            return False
        return begins
    if number.before(text, at, start) and following.isdigit():
        return False
    if always.before(text, at, start) or _vowelless(text, start, at):
        return False
    if before.isdigit():
        return begins and not ORDINALS.match(text, nxt)
    if before.isupper() and (at - 2 < start or text[at - 2] in " .(\"“„«-'’"):
        return False  # an initial
    if before.isalpha() and (at - 2 < start or text[at - 2] == " ") and before.islower():
        return begins and text[at - 3 : at - 2].isdigit()  # one small letter: 7 h. may end, z. B. does not
    return True


VOWELLESS = re.compile(r"(?<![\w'’.-])[B-DF-HJ-NP-TV-XZ]?[bcdfghjklmnpqrstvwxzßçñ]{2,4}$")


def _vowelless(text: str, start: int, at: int) -> bool:
    """Whether a short word without a vowel stands before the mark (Bldg., Hrn., blz.): written in small letters, it is cut short."""
    word = VOWELLESS.search(text, max(start, at - 7), at)
    return bool(word) and word.group().lower() not in NO_ABBREVIATION


#: A list marker: how it is written, and its number in each reading (digits, letter, Roman numeral).
Marker = tuple[tuple[str, str], dict[str, tuple[int, ...]]]


def _marker(item: re.Match) -> Marker:
    opener, body, closer = item.groups()
    if body[0].isdigit():
        return (opener, closer), {"1": tuple(map(int, body.split(".")))}
    case, small = ("a" if body.islower() else "A"), body.lower()
    kinds = {case: (ord(small) - 96,)} if len(body) == 1 else {}
    if small in ROMAN and (body.islower() or body.isupper()):
        kinds["roman " + case] = (ROMAN[small],)
    return (opener, closer), kinds


def _following(old: Marker, new: Marker, gaps: bool = False) -> dict[str, tuple[int, ...]]:
    """The readings in which a marker is the next of its list, or with ``gaps`` any later one."""

    def follows(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
        nexts = [(*a[:k], a[k] + 1) for k in range(len(a))]
        return b in nexts or b == (*a, 1) or any(b == (*n, 1) for n in nexts) or (gaps and b > a)

    if old[0] != new[0]:
        return {}
    return {k: b for k, b in new[1].items() if k in old[1] and follows(old[1][k], b)}


def _first(marker: Marker) -> dict[str, tuple[int, ...]]:
    return {k: n for k, n in marker[1].items() if n[-1] == 1}


def split_block(text: str, lines: list[int] | None = None) -> list[tuple[int, int]]:
    """Start and end of each sentence of one block of text without line breaks; ``lines`` are the places its lines began at."""
    size = len(text)
    found: list[tuple[int, int]] = []
    start = guard = SPACES.match(text).end()  # marks before the guard belong to an item number
    stack: list[tuple[str, int]] = []  # expected closers and where they were opened
    pending = -1  # end of an end mark inside a quotation or brackets, only closers after it so far
    levels: list[Marker] = []  # the last item of each list still open, outermost first
    heads = [m for m in (ITEM.match(text, SPACES.match(text, a).end()) for a in (lines or [0])) if m]  # items at the starts of lines
    carried: list[bool] = [False] * len(heads)  # whether the next item written alike is the next number
    later: dict[tuple, Marker] = {}
    for k in range(len(heads) - 1, -1, -1):
        marker = _marker(heads[k])
        alike = [(marker[0], kind) for kind in marker[1]]
        carried[k] = any(a in later and _following(marker, later[a]) for a in alike)
        later.update(dict.fromkeys(alike, marker))
    head = 0

    def continues(marker: Marker, gaps: bool) -> bool:
        """Move the open lists on to an item that continues one of them; deeper ones end."""
        for depth in range(len(levels) - 1, -1, -1):
            kinds = _following(levels[depth], marker, gaps)
            if kinds:
                levels[depth:] = [(marker[0], kinds)]
                return True
        return False

    def opens(marker: Marker) -> None:
        if levels and levels[-1][0] == marker[0] and levels[-1][1].keys() == marker[1].keys():
            levels.pop()
        levels.append(marker)
        del levels[:-LEVELS]

    def close(end: int) -> None:
        nonlocal start, guard, pending
        found.append((start, end))
        start = guard = SPACES.match(text, end).end()
        pending = -1
        stack.clear()
        item = ITEM.match(text, start)
        if item and not (head < len(heads) and heads[head].start() == start):
            marker = _marker(item)
            if levels and continues(marker, False):
                guard = item.end()
            elif item.group(2) == "1" and goes_by(item, item.end()):
                opens(marker)
                guard = item.end()

    seconds: dict[tuple[str, str], int] = {}  # the last place of a second item, by how it is written

    def goes_by(item: re.Match, at: int) -> bool:
        """Whether, within a line or beyond, a second item follows the first one ``item``."""
        if not seconds:
            seconds["", ""] = -1
            seconds.update(((m.group(1), m.group(2)), m.start()) for m in SECOND.finditer(text))
        return seconds.get((item.group(1), item.group(3)), -1) >= at

    def reach(at: int) -> None:
        """Take up the items at starts of lines up to ``at``."""
        nonlocal start, guard, head
        while head < len(heads) and heads[head].start() <= at:
            item, more = heads[head], carried[head]
            head += 1
            here, marker = item.start(), _marker(item)
            if here < start or (here > start and (stack or here < guard)):
                continue
            if here == start:
                if not found:
                    opens(marker)
                elif not continues(marker, True):
                    if not _first(marker):
                        continue
                    opens((marker[0], _first(marker)))
                guard = item.end()
                continue
            # within a sentence: letters with a dot are initials or abbreviations here
            end = here
            while text[end - 1].isspace():
                end -= 1
            if (item.group(3) == "." and not item.group(2)[0].isdigit()) or (text[end - 1] == "." and any(t.before(text, end - 1, start) for t in (TRIES[0], TRIES[2]))):
                continue
            if not continues(marker, False):
                first = _first(marker)
                if not first or not (more or text[end - 1] in ":："):
                    continue
                opens((marker[0], first))
            close(end)
            guard = item.end()

    def goes_on(nxt: int, opened: int) -> bool:
        """Whether the sentence goes on at ``nxt`` after a quotation or brackets that ended with a mark."""
        if nxt >= size:
            return False
        following = text[nxt]
        if following in ",;:，、；：—–-~)" or text.startswith("»", nxt):
            return True
        if CJK.match(following):
            return bool(CJK_GOES_ON.match(text, nxt))
        if LOWER_START.match(text, nxt):
            return False
        if following.islower():
            return True
        if following.isalpha() and text[opened] not in "([{（" and SPOKE.match(text, nxt):
            return text[start:opened].strip() == ""
        return False

    for event in EVENT.finditer(text):
        at, end, kind = event.start(), event.end(), event.lastgroup
        reach(at)
        if at < guard:
            continue
        letter = event.group()
        if kind == "skip":
            continue
        if kind == "damaged":
            letter = DAMAGED[letter]
            kind = "open" if letter in PAIRS else "close" if letter in CLOSERS else "end" if letter in MARKS else "other"
            if kind == "other":
                continue
        if kind == "open" and letter == "“" and stack and stack[-1][0] == "“":
            kind = "close"
        if kind == "close" and letter == '"':
            inside = [k for k, (c, _) in enumerate(stack) if c == '"']
            if not inside:
                kind = "open"
        if kind == "open":
            closer = '"' if letter == '"' else PAIRS[letter]
            damaged = next((d for d, c in DAMAGED.items() if c == closer), closer)
            if text.find(closer, end) >= 0 or text.find(damaged, end) >= 0:
                stack.append((closer, at))
            continue
        if kind == "close":
            while stack and stack[-1][0] != letter and any(c == letter for c, _ in stack):
                stack.pop()
            if not stack or stack[-1][0] != letter:
                continue
            _, opened = stack.pop()
            if pending >= 0 and not text[pending:at].strip():
                pending = end
                if not stack:
                    nxt = SPACES.match(text, end).end()
                    rest = EVENT.match(text, nxt)
                    if rest and rest.lastgroup == "end" and nxt == end:
                        continue
                    if goes_on(nxt, opened):
                        pending = -1
                    else:
                        close(end)
            else:
                pending = -1
            continue
        if kind == "thai":
            if not stack and not text[:at].endswith("ฯ"):
                close(at)
            continue
        nxt = SPACES.match(text, end).end()
        if kind == "emoji":
            if not stack and (nxt >= size or (nxt > end and _begins(text, nxt)) or (nxt > end and CJK.match(text[nxt]))) and not EVENT_END.match(text, nxt):
                close(end)
            continue
        # an end mark
        if stack:
            pending = end
            continue
        if letter == "." and text[at - 1 : at] == "1" and (item := AFTER_COLON.search(text, max(start, at - 8), end)) and (first := ITEM.match(text, item.end() - 2)) and goes_by(first, end):
            opens(_marker(first))  # the first item of a list within the sentence that announces it
            continue
        if letter in (".", "．"):
            ends = _full_stop(text, start, at, end, nxt)
        elif all(c in ".…‥ ．" for c in letter):
            ends = nxt >= size or (not CJK.match(text[nxt]) and _begins(text, nxt) and not re.match(THAI, text[nxt]))
        else:
            following = text[nxt : nxt + 1]
            ends = following not in tuple(",;，、") or not following
            if nxt == end and following.isalnum() and letter in "!?" and following.islower() and following.isascii():
                ends = at > start and not text[at - 1].isascii() or bool(LOWER_START.match(text, nxt))
        if ends:
            close(end)
    reach(size)
    last = len(text.rstrip())
    if start < last:
        found.append((start, last))
    return found


SECOND = re.compile(rf"(?<=[{re.escape(MARKS)}\s])(\(?)2([.)])(?=\s)")
AFTER_COLON = re.compile(r"[:：]\s+1\.$")
EVENT_END = re.compile(rf"[{re.escape(MARKS)}]")
HEADER = re.compile(r"[^\s:]+:(?:[ \t]|$)|From ")
MARKERS = re.compile(r"(?:>[ \t]*)+")
NO_TEXT = re.compile(r"-{3,}|_{3,}|={3,}|\*{3,}")


def _lines(text: str) -> list[tuple[int, int]]:
    """Start and end of each line, line breaks (of either kind) left out."""
    spans, at = [], 0
    while True:
        end = text.find("\n", at)
        if end < 0:
            spans.append((at, len(text)))
            return spans
        spans.append((at, end - 1 if end > at and text[end - 1] == "\r" else end))
        at = end + 1


def _fields(text: str, lines: list[tuple[int, int]]) -> dict[str, str]:
    """Header fields, unfolded; the first of each name counts."""
    fields: dict[str, str] = {}
    name = ""
    for a, b in lines:
        line = text[a:b]
        if line[:1] in (" ", "\t"):
            if name:
                fields[name] += " " + line.strip()
            continue
        head, colon, value = line.partition(":")
        name = head.strip().lower() if colon and head.lower().strip() not in fields else ""
        if name:
            fields[name] = value.strip()
    return fields


BOUNDARY = re.compile(r"boundary\s*=\s*(?:\"([^\"]*)\"|([^\s;]+))", re.I)


def _bodies(text: str, lines: list[tuple[int, int]], fields: dict[str, str]) -> Iterator[list[tuple[int, int]]]:
    """The lines of each readable part."""
    kind = fields.get("content-type", "text/plain").partition(";")[0].strip().lower() or "text/plain"
    if kind.startswith("multipart/"):
        mark = BOUNDARY.search(fields["content-type"])
        if not mark:
            return
        border = "--" + (mark.group(1) or mark.group(2) or "")
        part: list[tuple[int, int]] | None = None
        for a, b in [*lines, (-1, -1)]:
            line = text[a:b].rstrip() if a >= 0 else border + "--"
            if line in (border, border + "--"):
                if part is not None:
                    cut = next((i for i, (x, y) in enumerate(part) if not text[x:y].strip()), len(part))
                    yield from _bodies(text, part[cut + 1 :], _fields(text, part[:cut]))
                part = [] if line == border else None
                if line != border and a >= 0:
                    return
            elif part is not None:
                part.append((a, b))
        return
    if kind == "text/plain" and fields.get("content-transfer-encoding", "").strip().lower() not in ("base64", "quoted-printable"):
        yield lines


def _blocks(text: str, lines: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """Runs of non-blank lines of one quote depth, quote marks cut off."""
    block: list[tuple[int, int]] = []
    depth = 0
    for a, b in lines:
        marks = MARKERS.match(text, a, b)
        level = marks.group().count(">") if marks else 0
        start = marks.end() if marks else a
        content = text[start:b]
        if not level and content in ("--", "-- "):
            break
        blank = not content.strip()
        if block and (blank or level != depth):
            yield block
            block = []
        if not blank:
            block.append((start, b))
            depth = level
    if block:
        yield block


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Start and end (in code points, end exclusive) of every sentence of a mail's readable text."""
    if not text:
        return []
    lines = _lines(text)
    fields: dict[str, str] = {}
    if HEADER.match(text, *lines[0]):
        cut = next((i for i, (a, b) in enumerate(lines) if not text[a:b].strip()), len(lines))
        fields, lines = _fields(text, lines[:cut]), lines[cut + 1 :]
    found = []
    for body in _bodies(text, lines, fields):
        for block in _blocks(text, body):
            a, b = block[0]
            if NO_TEXT.match(text, SPACES.match(text, a, b).end(), b):
                continue
            # the block's lines joined by single spaces; places turns an offset back into one of the text
            joined = " ".join(text[x:y] for x, y in block)
            places, at = [], 0
            for x, y in block:
                places.append(at)
                at += y - x + 1
            for s, e in split_block(joined, places):
                i, j = bisect_right(places, s) - 1, bisect_right(places, e - 1) - 1
                found.append((block[i][0] + s - places[i], block[j][0] + e - places[j]))
    return found


def find_sentences(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per sentence: key, start_char, end_char.

    Null, empty and blank texts, and texts without readable parts, have no sentences. Repeated keys
    keep the sentences of each row; other columns are ignored. A text of any length is one unit of
    work, read in time near to its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, starts, ends = [], [], []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for s, e in sentences(body):
                    keys.append(doc)
                    starts.append(s)
                    ends.append(e)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["doc", "start_char", "end_char"])

    made = df.select(F.col(key).cast("bigint").alias("doc"), text).mapInArrow(run, "doc bigint, start_char int, end_char int")
    return made.withColumnRenamed("doc", key)

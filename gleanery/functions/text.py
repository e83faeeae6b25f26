"""Text and category normalisation as Column builders."""

import html
import json
import zlib
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanery import vocab

# Unicode white space plus the ASCII separators 0x1c-0x1f, spelled out because
# Java's \s is ASCII only.
WS = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")

_COMMON_ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'",
    "&#x27;": "'", "&nbsp;": " ", "&amp;": "&",
}


WS_CHARS = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WS_CHARS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def present(c: Column) -> Column:
    """True for a text that is neither NULL nor empty (never NULL itself)."""
    return F.coalesce(c != "", F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for cond in conditions:
        out = out | cond
    return out


def let(value: Column, fn) -> Column:
    """fn(value) with the value computed once, however often fn refers to it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def literals(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


# Vocabularies are constant arrays searched by a lambda. As long CASE and OR
# chains they would grow the generated method beyond what the JVM compiles.


def contains_any(c: Column, words: list[str], whole_word: bool = False) -> Column:
    """Substring test against a word list; `whole_word` asks for word borders."""
    if whole_word:
        return c.rlike(word_pattern(words))
    if len(words) <= 3:
        return any_of([c.contains(w) for w in words])
    return let(c, lambda t: F.exists(literals(words), lambda w: F.contains(t, w)))


def _occurs(t: Column, word: Column, whole_word: bool) -> Column:
    if whole_word:
        return F.regexp_like(t, F.concat(F.lit(r"(?<!\w)\Q"), word, F.lit(r"\E(?!\w)")))
    return F.contains(t, word)


def first_hit(c: Column, pairs: list[tuple[str, str]], whole_word: bool = False) -> Column:
    """Value of the first (word, value) pair whose word occurs; NULL if none."""
    table = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(v).alias("value")) for w, v in pairs])
    return let(c, lambda t: F.get(F.filter(table, lambda p: _occurs(t, p["word"], whole_word)), F.lit(0)))["value"]


def word_pattern(words: list[str]) -> str:
    quoted = "|".join("\\Q" + w + "\\E" for w in words)
    return rf"(?<![\w])(?:{quoted})(?![\w])"


#: Slots that the names of references are dealt to, about one name in two of them.
_SLOTS = 4096
#: The longest name that may stand without its semicolon.
_OPEN_NAME = max(len(n) for n in html5 if not n.endswith(";"))
_REFERENCE = r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@lru_cache(1)
def _name_table() -> str:
    """The named references by slot, as JSON: one literal that is read once per plan."""
    slots = [[] for _ in range(_SLOTS)]
    for name, text in html5.items():
        slots[zlib.crc32(name.encode()) % _SLOTS].append({"n": name, "t": text})
    return json.dumps(slots, ensure_ascii=False, separators=(",", ":"))


def _named(name: Column) -> Column:
    """What a named reference (without its `&`) stands for; NULL for none."""
    slots = F.from_json(F.lit(_name_table()), "array<array<struct<n: string, t: string>>>")
    slot = F.get(slots, F.pmod(F.crc32(name.cast("binary")), F.lit(_SLOTS)).cast("int"))
    return F.get(F.filter(slot, lambda e: e["n"] == name), F.lit(0))["t"]


def _open_name(head: Column) -> Column:
    """The longest name without semicolon that `head` begins with, replaced; `head` as it was if there is none."""
    sizes = F.filter(F.sequence(F.lit(_OPEN_NAME), F.lit(2)), lambda n: n < F.char_length(head))
    found = F.get(F.filter(F.transform(sizes, lambda n: F.concat(
        _named(F.left(head, n)), F.substring(head, n + 1, F.char_length(head)))), lambda t: t.isNotNull()), F.lit(0))
    return F.coalesce(found, F.concat(F.lit("&"), head))


def _numbered(head: Column) -> Column:
    """The character of `#123;` or `#x7b;`; what is no character follows the rules for browsers."""
    digits = F.rtrim(F.ltrim(F.regexp_replace(head, "^#[xX]?", ""), F.lit("0")), F.lit(";"))
    base = F.when(head.rlike("^#[xX]"), 16).otherwise(10)
    # The first codes stand for what the standard library says they do.
    low = F.array(*[F.lit(html.unescape(f"&#{n};")) for n in range(0xA0)])

    def character(n: Column) -> Column:
        wide = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return (F.when(n < 0xA0, F.get(low, n.cast("int")))
                .when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd")
                .when(n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE), "")
                .otherwise(wide))

    number = F.when(F.length(digits) > 7, 0x110000).when(digits == "", 0).otherwise(F.when(
        base == 16, F.conv(digits, 16, 10)).otherwise(digits).cast("long"))
    return let(number.cast("long"), character)


def _resolved(part: Column) -> Column:
    """A text that followed an ampersand, its reference replaced."""
    def with_head(head: Column) -> Column:
        meant = F.when(F.startswith(head, F.lit("#")), _numbered(head)).otherwise(
            F.coalesce(_named(head), _open_name(head)))
        return F.when(head == "", F.concat(F.lit("&"), part)).otherwise(
            F.concat(meant, F.substring(part, F.char_length(head) + 1, F.char_length(part))))
    return let(F.regexp_extract(part, _REFERENCE, 0), with_head)


def unescape_html(c: Column) -> Column:
    """Character references to characters, as the standard library reads them.

    The common references are replaced at once (`&amp;` last, which equals one pass).
    Texts with another possible reference are cut at the ampersands; names are found in
    a constant table by their checksum, unterminated ones by their longest known prefix.
    """
    common = "|".join(e[1:-1] for e in _COMMON_ENTITIES)
    rest = F.regexp_replace(c, f"&(?:{common});", "")
    rare = rest.rlike(r"&[^\t\n\f <&;]")
    native = c
    for entity, char in _COMMON_ENTITIES.items():
        native = F.replace(native, F.lit(entity), F.lit(char))
    parts = F.split(c, "&")
    every = F.array_join(F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(_resolved(p))), "")
    return F.when(~c.contains("&"), c).when(rare, every).otherwise(native)


def squeeze(c: Column) -> Column:
    """Tags to blanks, white space runs to one blank, trimmed, '' to NULL."""
    no_tags = F.when(c.contains("<"), F.regexp_replace(c, "<[^>]+>", " ")).otherwise(c)
    return blank_to_null(F.trim(F.regexp_replace(no_tags, f"{WS}+", " ")))


def clean_text(c: Column) -> Column:
    return squeeze(unescape_html(c))


def normalize_job_type(c: Column, mapping=None, whole_word: bool = False) -> Column:
    """First entry of the ordered map that occurs, else the lowered text."""
    raw = strip(F.lower(c))
    hit = first_hit(raw, mapping or vocab.JOB_TYPES, whole_word)
    return F.when(present(c), F.coalesce(hit, raw))


def normalize_experience_level(c: Column, buckets=None, whole_word: bool = False) -> Column:
    """First bucket with a word that occurs, else the lowered text."""
    raw = strip(F.lower(c))
    pairs = [(w, level) for level, words in buckets or vocab.EXPERIENCE_LEVELS for w in words]
    return F.when(present(c), F.coalesce(first_hit(raw, pairs, whole_word), raw))


def remote_haystack(*cols: Column) -> Column:
    return F.lower(F.concat_ws(" ", *[blank_to_null(c) for c in cols]))


def detect_remote(flag: Column, haystack: Column, phrases=None, whole_word=False) -> Column:
    hit = contains_any(haystack, phrases or vocab.REMOTE_PHRASES, whole_word)
    return F.coalesce(flag, F.lit(False)) | hit


def default_currency(currency: Column, low: Column, high: Column, location: Column,
                     places=None, local: str = "KES", other: str = "USD") -> Column:
    paid = F.coalesce(low != 0, F.lit(False)) | F.coalesce(high != 0, F.lit(False))
    place = F.lower(F.coalesce(location, F.lit("")))
    guess = F.when(contains_any(place, places or vocab.KES_PLACES), local).otherwise(other)
    return F.when(paid & ~present(currency), guess).otherwise(currency)


def extract_tags(lowered: Column, keywords=None, whole_word: bool = False) -> Column:
    """Keywords found in an already lowered text, comma-joined in list order."""
    words = keywords if keywords is not None else vocab.TAG_KEYWORDS
    if len(words) <= 64 and not whole_word:  # short enough for generated code
        hits = F.array(*[F.when(lowered.contains(w), F.lit(w)) for w in words])
    else:
        hits = let(lowered, lambda t: F.filter(literals(words), lambda w: _occurs(t, w, whole_word)))
    return blank_to_null(F.array_join(hits, ","))


def title_case(c: Column) -> Column:
    """Capitalise every run of cased letters (not only after blanks, as initcap
    does); a letter whose capital is two letters keeps the second one small."""
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    runs = F.regexp_extract_all(c, F.lit(f"[{cased}]+|[^{cased}]+"), F.lit(0))

    def capitalise(run: Column) -> Column:
        head = F.upper(F.left(run, F.lit(1)))
        return F.concat(F.left(head, F.lit(1)), F.lower(F.substring(head, 2, 9)),
                        F.lower(F.substring(run, 2, 1 << 30)))

    return F.array_join(F.transform(runs, capitalise), "")


def like_pattern(pattern: str) -> str:
    """Make a LIKE pattern safe for Spark, which rejects an escape character
    before an ordinary one where SQL databases simply drop it."""
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            nxt = pattern[i + 1:i + 2]
            out.append("\\" + nxt if nxt in ("%", "_", "\\") else nxt)
            i += 2
            continue
        out.append(ch)
        i += 1
    return "".join(out)


def escape_like(text: str) -> str:
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def truncate(c: Column, width: int) -> Column:
    return F.left(c, F.lit(width))

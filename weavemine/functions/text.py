"""Column functions over text: tokens, normal forms, keys. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORDS = r"[a-z0-9]+(?:[-.][a-z0-9]+)*"
LETTERS_FIRST = r"[a-z][a-z0-9]+"


def search_words(text: Column) -> Column:
    """Search tokens of the lower-cased text, repeats included; null text has none."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(WORDS), F.lit(0)), F.array().cast("array<string>"))


def discovery_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(LETTERS_FIRST), F.lit(0)), F.array().cast("array<string>"))


def one_line(text: Column) -> Column:
    """White space collapsed (as Unicode has it), ends trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def _beginning(text: Column, other: str, kept: str, n: int) -> Column:
    """The text up to its n-th character of the class ``kept``, or the last where there are fewer; ``other`` is the opposite class.

    For forms cut to a length that the kept characters reach by themselves. Possessive: a loop without recursion or steps back.
    """
    return F.regexp_extract(text, rf"(?U)^(?:{other}*+{kept}){{0,{n}}}+", 0)


def clip(text: Column, n: int) -> Column:
    """On one line, at most n characters: cut after a whole word, with an ellipsis."""
    line = one_line(_beginning(text, r"\s", r"\S", n + 1))
    head = F.substring(line, 1, n - 1)
    word = F.when(F.contains(head, F.lit(" ")), F.regexp_replace(head, " [^ ]*$", "")).otherwise(head)
    return F.when(F.char_length(line) <= n, line).otherwise(F.concat(F.rtrim(word), F.lit("…")))


def first_sentence(text: Column, n: int) -> Column:
    """Up to the first stop, question or exclamation mark before a space, clipped."""
    line = one_line(_beginning(text, r"\s", r"\S", n + 1))
    sentence = F.regexp_extract(line, r"^(.*?[.!?])\s", 1)
    return clip(F.when(sentence != "", sentence).otherwise(line), n)


def whole_sentences(text: Column) -> Column:
    """The text as far as its last whole sentence or line; a stop after a bare number ends none. Empty where there is none."""
    return F.regexp_replace(F.regexp_extract(text, "(?s)^(.*(?:(?<![\\s\\d])[.!?][\"'\u201d)\\]]*(?=\\s|$)|\\n))", 1), r"\s+$", "")


def slug(text: Column, n: int = 80) -> Column:
    """A file name of letters, digits, dots, underscores and hyphens; ``unnamed`` where nothing is left."""
    # ends in a letter, digit or hyphen: nothing is left to trim there
    kept = F.regexp_replace(F.regexp_replace(_beginning(text, "[^A-Za-z0-9-]", "[A-Za-z0-9-]", n), r"[^A-Za-z0-9._-]+", "_"), r"^[._]+", "")
    return F.substring(F.when(kept == "", "unnamed").otherwise(kept), 1, n)


def safe_file_name(name: Column, n: int = 80) -> Column:
    """Without characters that file systems refuse; cut after a whole word."""
    clean = one_line(F.regexp_replace(name, r"""[<>:"/\\|?*\x00-\x1f`]+""", " "))
    clean = F.regexp_replace(clean, r"^[ .]+|[ .]+$", "")
    head = F.substring(clean, 1, n)
    return F.when(F.char_length(clean) <= n, clean).otherwise(F.regexp_replace(F.regexp_replace(head, " [^ ]*$", ""), r"[ .]+$", ""))


def tidy(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), r"(?U)^\s+|\s+$", "")


#: Characters that XML 1.0 forbids, as a class of a regular expression.
FORBIDDEN = r"\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff"


def xml_safe(text: Column) -> Column:
    """Without the characters that XML 1.0 forbids."""
    return F.regexp_replace(text, f"[{FORBIDDEN}]", "")


def cell(text: Column, n: int, most: int = 32_767) -> Column:
    """Text for a table cell: null is empty, forbidden characters go, a long one is cut."""
    n = min(n, most)
    s = F.coalesce(xml_safe(_beginning(text.cast("string"), f"[{FORBIDDEN}]", f"[^{FORBIDDEN}]", n + 1)), F.lit(""))
    return F.when(F.char_length(s) <= n, s).otherwise(F.concat(F.substring(s, 1, n - 1), F.lit("…")))


def plural(n: Column, noun: str) -> Column:
    return F.concat(F.format_number(n, 0), F.lit(f" {noun}"), F.when(n == 1, "").otherwise("s"))


def plural_kind(kind: Column) -> Column:
    """A metaclass as plural words: ConnectorEnd, connector ends."""
    words = F.lower(F.regexp_replace(kind, "(?<=[a-z])(?=[A-Z])", " "))
    ies = words.rlike("(^|[^aeiou])y$")
    return F.when(ies, F.regexp_replace(words, "y$", "ies")).when(words.rlike("(s|x|ch)$"), F.concat(words, F.lit("es"))).otherwise(F.concat(words, F.lit("s")))


def escape_markdown(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\`*\[\]<])", r"\\$1")


def unescape_markdown(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\`*\[\]<])", "$1")


def links_to_labels(text: Column) -> Column:
    """Links reduced to their labels; a label may hold escaped brackets."""
    return F.regexp_replace(text, r"\[((?:[^\[\]\\]|\\.)*)\]\([^)]*\)", "$1")


TRACE_LINE = r"<sub>trace: `[^`]*`</sub>"


def flatten_for_phrases(text: Column) -> Column:
    """Lower case, links replaced by their labels, trace lines, code and bold marks and escapes dropped, spaces collapsed."""
    return one_line(F.regexp_replace(F.lower(links_to_labels(F.regexp_replace(text, TRACE_LINE, ""))), r"[`*\\]", ""))


def markdown_to_plain(text: Column) -> Column:
    """Markup that the pages write removed, and only that: links, trace lines, bold, roles in italics, origins, code marks, escapes."""
    s = links_to_labels(F.regexp_replace(text, r"[ \t]*" + TRACE_LINE + r"[ \t]*", ""))
    s = F.regexp_replace(s, r"(?<![\w*\\])\*\*(?=\S)((?:[^*\n\\]|\\.)+?)(?<=\S)\*\*(?![\w*])", "$1")
    s = F.regexp_replace(s, r"(?m)^(\s*- )\*(?=\S)([^*\n]+?)(?<=\S)\* ", "$1$2 ")
    s = F.regexp_replace(s, r"(?<!\w)_\(([^)\n]*)\)_", "($1)")
    s = unescape_markdown(F.regexp_replace(s, "`", ""))
    return F.regexp_replace(F.regexp_replace(s, r"\n{3,}", "\n\n"), r"(?U)^\s+|\s+$", "")


def front_matter(meta: Column) -> Column:
    """A map as front matter, values as JSON."""
    value = lambda v: F.regexp_extract(F.to_json(F.array(v)), r"(?s)^\[(.*)\]$", 1)
    lines = F.transform(F.map_entries(meta), lambda e: F.concat(e["key"], F.lit(": "), value(e["value"])))
    return F.concat(F.lit("---\n"), F.array_join(F.concat(lines, F.array(F.lit("---"), F.lit(""))), "\n"))


def read_front_matter(page: Column) -> Column:
    """The string values of a page's front matter, as a map."""
    block = F.regexp_extract(page, r"(?s)^---\n(.*?)\n---\n", 1)
    lines = F.filter(F.split(block, "\n"), lambda x: x.rlike('^[^:]+: "'))
    text = lambda x: F.get_json_object(F.concat(F.lit("["), F.regexp_extract(x, r"^[^:]+: (.*)$", 1), F.lit("]")), "$[0]")
    return F.map_from_entries(F.transform(lines, lambda x: F.struct(F.regexp_extract(x, "^([^:]+): ", 1).alias("key"), text(x).alias("value"))))


def media_type(head: Column) -> Column:
    """The type of an embedded image by its first bytes; null for others."""
    h = F.hex(F.substring(head, 1, 4))
    return F.when(h == "89504E47", "image/png").when(h.startswith("FFD8FF"), "image/jpeg").when(h == "47494638", "image/gif")


#: How some bytes begin, in hex, and what they are called.
MAGIC = (("3C3F786D6C", "XML"), ("3C737667", "SVG image"), ("89504E47", "PNG image"), ("FFD8FF", "JPEG image"), ("47494638", "GIF image"), ("504B0304", "zip archive"))


def shown_value(value: Column, most: int = 4000) -> Column:
    """A value as a page shows it: long hex dumps described, other long ones cut."""
    tokens = F.split(F.trim(F.regexp_replace(value, r"\s+", " ")), " ")
    dump = (F.char_length(value) > most) & value.rlike(r"^(?:[0-9a-fA-F]{1,2}\s+){16}") & value.rlike(r"^[0-9a-fA-F\s]+$")
    first = F.slice(F.split(F.trim(F.regexp_replace(F.substring(value, 1, 2000), r"\s+", " ")), " "), 1, 512)
    head = F.regexp_replace(F.upper(F.array_join(F.transform(first, lambda x: F.lpad(x, 2, "0")), "")), "^(?:20|09|0A|0D|0B|0C)+", "")
    kind = F.lit("binary data")
    for begins, name in reversed(MAGIC):
        kind = F.when(head.startswith(begins), name).otherwise(kind)
    kind = F.when((kind == "XML") & F.contains(head, F.lit("3C737667")), "SVG image").otherwise(kind)
    described = F.concat(F.lit("("), kind, F.lit(", "), F.format_number(F.size(tokens), 0), F.lit(" bytes, hex-encoded; not shown)"))
    cut = F.concat(F.substring(value, 1, most), F.lit("… (cut; "), F.format_number(F.char_length(value), 0), F.lit(" characters in all)"))
    return F.when(dump, described).when(F.char_length(value) > most, cut).otherwise(value)


#: An id in brackets that starts a text, a list mark before it allowed.
LEADING_ID = r"^\s*(?:[-–•*]\s+)?\[([A-Z][A-Z0-9]*(?:-[A-Z0-9]+)+)\]\s*"


def requirement_title(name: Column, rid: Column, text: Column) -> Column:
    """Name and id, or without a name the id and the start of the text; an id that starts the text comes before the given one."""
    line = F.coalesce(one_line(text), F.lit(""))
    inner = F.regexp_extract(line, LEADING_ID, 1)
    rid = F.when(inner != "", inner).otherwise(F.nullif(rid, F.lit("")))
    body = F.when(inner != "", F.regexp_replace(line, LEADING_ID, "")).otherwise(line)
    head = F.regexp_replace(F.substring(body, 1, 89), " [^ ]*$", "")
    start = F.when(F.char_length(body) <= 90, body).otherwise(F.concat(head, F.lit("…")))
    named = F.when(rid.isNotNull(), F.concat(name, F.lit(" ("), rid, F.lit(")"))).otherwise(name)
    unnamed = F.when(rid.isNotNull() & (start != ""), F.concat(rid, F.lit(": "), start)).otherwise(F.coalesce(rid, F.nullif(start, F.lit("")), F.lit("(unnamed)")))
    return F.when(F.coalesce(name, F.lit("")) != "", named).otherwise(unnamed)


def alphanumeric(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " "))


def anchor(term: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(term), r"[^a-z0-9-]+", "-"), r"^-+|(?<!-)-+$", "")


def identifiers(text: Column) -> Column:
    """Upper-case hyphenated tokens with a digit, without names of encodings."""
    found = F.regexp_extract_all(text, F.lit(r"(?U)(?<![\w-])[A-Z][A-Z0-9]*(?:-[A-Z0-9]+)+(?![\w-])"), F.lit(0))
    return F.filter(found, lambda t: t.rlike("[0-9]") & ~t.rlike(r"^(?:(?:UTF|UCS|WINDOWS)-\d+|US-ASCII|ISO-8859-\d+|X-[A-Z0-9-]+)$"))


#: Words that say nothing of a subject.
STOP = ("a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "have", "in", "into", "is", "it", "its", "of", "on", "or", "that", "the", "this", "to", "with", "which", "what", "how", "each", "their", "they", "these", "those", "diagram", "model", "package", "shows", "show", "showing", "describes", "defines")


def subject_words(text: Column) -> Column:
    """Discovery tokens without stop words, repeats included."""
    return F.filter(discovery_tokens(text), lambda w: ~w.isin(*STOP))


def mention_snippet(text: Column, term: Column, around: int = 90) -> Column:
    """The text around the first mention of a term, or its start, cut at words, with ellipses."""
    line = one_line(text)
    found = F.instr(line, term)
    size = F.char_length(term)
    i = F.greatest(found - 1, F.lit(0))
    a = F.greatest(i - around, F.lit(0))
    b = F.least(F.char_length(line), i + size + F.when(found > 0, around).otherwise(2 * around))
    before, after = F.substring(line, a + 1, i - a), F.substring(line, i + size + 1, F.greatest(b - i - size, F.lit(0)))
    a = a + F.when(a > 0, F.instr(before, F.lit(" "))).otherwise(0)
    last = F.instr(F.reverse(after), F.lit(" "))
    z = F.when((b < F.char_length(line)) & (last > 0), i + size + F.char_length(after) - last).otherwise(b)
    middle = F.trim(F.substring(line, a + 1, z - a))
    return F.concat(F.when(a > 0, "…").otherwise(""), middle, F.when(z < F.char_length(line), "…").otherwise(""))


def few(items: Column, most: int = 3) -> Column:
    """The first of a list, and how many more there are."""
    more = F.when(F.size(items) > most, F.concat(F.lit(" and "), (F.size(items) - most).cast("string"), F.lit(" more"))).otherwise("")
    return F.concat(F.array_join(F.slice(items, 1, most), ", "), more)


def plus_minus(plus: Column, minus: Column, most: int = 3) -> Column:
    """What is only here and only there, in brackets."""
    parts = F.array_compact(F.array(F.when(F.size(plus) > 0, F.concat(F.lit("only here: "), few(plus, most))), F.when(F.size(minus) > 0, F.concat(F.lit("only there: "), few(minus, most)))))
    return F.concat(F.lit(" ("), F.array_join(parts, "; "), F.lit(")"))


def added_removed(here: Column, there: Column) -> Column:
    """struct(plus, minus): what two lists of strings hold more of than each other, repeats counted, sorted."""
    count = lambda xs, v: F.size(F.filter(xs, lambda x: x == v))
    more = lambda xs, ys: F.flatten(F.transform(F.array_sort(F.array_distinct(xs)), lambda v: F.array_repeat(v, F.greatest(count(xs, v) - count(ys, v), F.lit(0)))))
    return F.struct(more(here, there).alias("plus"), more(there, here).alias("minus"))


def shared_levels(a: Column, b: Column, separator: str = "::") -> Column:
    """How many leading parts two paths share."""
    x, y = F.split(a, separator), F.split(b, separator)
    pairs = F.slice(F.arrays_zip(x.alias("x"), y.alias("y")), F.lit(1), F.least(F.size(x), F.size(y)))
    start = F.struct(F.lit(0).alias("n"), F.lit(True).alias("on"))
    step = lambda s, p: F.struct((s["n"] + F.when(s["on"] & (p["x"] == p["y"]), 1).otherwise(0)).alias("n"), (s["on"] & (p["x"] == p["y"])).alias("on"))
    return F.aggregate(pairs, start, step)["n"]


def parted_paths(a: Column, b: Column) -> Column:
    """struct(here, there): two package paths from the last part they share on."""
    n = F.when((a == "") | (b == ""), 0).otherwise(shared_levels(a, b))
    first = F.greatest(n - 1, F.lit(0))

    def shown(path: Column) -> Column:
        parts = F.split(path, "::")
        tail = F.array_join(F.slice(parts, first + 1, F.size(parts)), "::")
        return F.when(path == "", "(the root)").otherwise(F.concat(F.when(first > 0, "…::").otherwise(""), tail))

    return F.struct(shown(a).alias("here"), shown(b).alias("there"))


def location(owner: Column, project: Column) -> Column:
    """Where something is: the last three packages of its owner's path, and the project."""
    parts = F.split(owner, "::")
    path = F.array_join(F.slice(parts, F.greatest(F.size(parts) - 2, F.lit(1)), 3), "::")
    return F.concat(F.when(F.coalesce(owner, F.lit("")) != "", F.concat(F.lit("in "), path, F.lit(" "))).otherwise(""), F.lit("(project "), project, F.lit(")"))


def package_levels(path: Column, n: int = 3) -> list[Column]:
    """The first levels of a package path, null where there is none."""
    parts = F.split(F.nullif(path, F.lit("")), "::")
    return [F.get(parts, F.lit(k)).alias(f"package_{k + 1}") for k in range(n)]


def reply_json(reply: Column) -> Column:
    """The JSON object in a reply, from its first brace to its last; null where it can't be read."""
    body = F.nullif(F.regexp_extract(reply, r"(?s)(\{.*\})", 1), F.lit(""))
    return F.when(F.try_parse_json(body).isNotNull(), body)


def reply_field(reply: Column, key: str) -> Column:
    """A field of a reply: from its JSON, and only where that can't be read by its look."""
    looks = F.nullif(F.regexp_extract(reply, rf'"{key}"\s*:\s*"?([A-Za-z0-9]+)', 1), F.lit(""))
    braces = reply.rlike(r"(?s)\{.*\}")
    return F.when(reply_json(reply).isNotNull(), F.get_json_object(reply_json(reply), f"$.{key}")).when(braces, looks)


def holds(evidence: Column, flat: Column) -> Column:
    """Whether a flattened text holds all phrases of one of the alternatives (array of arrays of flattened phrases)."""
    return F.exists(evidence, lambda alt: (F.size(alt) > 0) & F.forall(alt, lambda p: F.contains(flat, p)))


def patch_sides(w: Column, h: Column, patch: int = 48) -> Column:
    """A picture's sides cut down to whole patches, one at least."""
    side = lambda x: F.greatest(F.lit(patch), (F.floor(x / patch) * patch).cast("int"))
    return F.struct(side(w).alias("w"), side(h).alias("h"))


def merged_metadata(files: Column, pairs: Column) -> Column:
    """Two maps as one; values given as pairs come before those of files."""
    return F.map_concat(F.map_filter(files, lambda k, v: ~F.array_contains(F.map_keys(pairs), k)), pairs)


def classed_kind(kind: Column, about: Column) -> Column:
    return F.concat_ws("#", kind, F.nullif(about, F.lit("")))


def text_digest(text: Column) -> Column:
    """16 hex digits, blind to white space."""
    return F.substring(F.sha2(one_line(text), 256), 1, 16)


def chunk_id(*parts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 24)


def natural_key(text: Column) -> Column:
    """Sorts digits as numbers and before text: array of (kind, number, text)."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"\d+|\D+"), F.lit(0))
    number = lambda r: r.rlike(r"^\d")
    return F.transform(
        runs,
        lambda r: F.struct(
            F.when(number(r), 0).otherwise(1).alias("kind"),
            F.when(number(r), r.try_cast("decimal(38,0)")).alias("number"),
            F.when(number(r), F.lit("")).otherwise(r).alias("text"),
        ),
    )


#: What a word weighs, and each letter past so many; a number and each digit; any other mark; and the share added.
WORD, LETTER, LETTERS = 1.07, 0.415, 6
NUMBER, DIGIT, MARK, SPARE = 0.42, 0.375, 0.95, 1.2


def token_estimate(text: Column) -> Column:
    """About how many tokens an embedding model makes of the text, by weights; each letter beyond A to Z counts as a word."""
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    letters = lambda pattern: F.char_length(F.regexp_replace(text, pattern, ""))
    beyond = count(r"[\p{L}&&[^A-Za-z]]")
    words, numbers, marks = count("[A-Za-z]+") + beyond, count("[0-9]+"), count(r"[^\sA-Za-z0-9]") - beyond
    long_part = F.aggregate(F.regexp_extract_all(text, F.lit("[A-Za-z]{%d,}" % (LETTERS + 1)), F.lit(0)), F.lit(0), lambda n, w: n + F.char_length(w) - LETTERS)
    total = WORD * words + LETTER * long_part + NUMBER * numbers + DIGIT * letters("[^0-9]") + MARK * marks
    return F.ceil(F.round(SPARE * total, 9)).cast("long")


def strip_tags(html: Column) -> Column:
    """Text of simple html: script, style and head dropped, tags as spaces."""
    body = F.regexp_replace(html, r"(?is)<(script|style|head)\b.*?</\1\s*>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(body, r"(?s)<[^>]*>", " "), r"\s+", " "))

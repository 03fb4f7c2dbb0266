"""Column functions on hand-made values: many columns of one row a query."""

import time

from pyspark.sql import functions as F

from weavemine.functions import origins as O
from weavemine.functions import prose as P
from weavemine.functions import text as T

L = F.lit


def row(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_short_texts(spark):
    r = row(
        spark,
        clip=T.clip(L("some words\n here"), 9), clip2=T.clip(L("abcdefghijkl"), 9), clip3=T.clip(L("abc efgh ijk"), 9), clip4=T.clip(L("fits"), 9),
        sentence=T.first_sentence(L("One v1.2\nends. Two."), 90), whole=T.whole_sentences(L("It is so. See 2. And then it br")), whole2=T.whole_sentences(L("none at all")), whole3=T.whole_sentences(L("a list\nof th")),
        slug=T.slug(L("..a b/c..")), slug2=T.slug(L("***")), safe=T.safe_file_name(L(' a<b>: c|d. '), 80), safe2=T.safe_file_name(L("one two three"), 9), tidy=T.tidy(L(" a\r\nb \n")),
        xml=T.xml_safe(L("a\x0bb\x00c")), cell=T.cell(L("abcdef"), 4), cell2=T.cell(L(None).cast("string"), 4), p1=T.plural(L(1), "row"), p2=T.plural(L(1234), "row"),
        k1=T.plural_kind(L("Property")), k2=T.plural_kind(L("ConnectorEnd")), k3=T.plural_kind(L("Class")), k4=T.plural_kind(L("Key")),
    )
    assert (r.clip, r.clip2, r.clip3, r.clip4) == ("some…", "abcdefgh…", "abc…", "fits")
    assert (r.sentence, r.whole, r.whole2, r.whole3) == ("One v1.2 ends.", "It is so.", "", "a list")
    assert (r.slug, r.slug2, r.safe, r.safe2, r.tidy) == ("a_b_c", "unnamed", "a b c d", "one two", "a\nb")
    assert (r.xml, r.cell, r.cell2, r.p1, r.p2) == ("abc", "abc…", "", "1 row", "1,234 rows")
    assert (r.k1, r.k2, r.k3, r.k4) == ("properties", "connector ends", "classes", "keys")


def test_forms_look_no_further_than_they_need(spark):
    """Work does not grow with what is cut off, nor with the square of a run of stops; where spaces, marks and forbidden characters stand changes nothing."""
    dots, far = F.concat(L("a"), F.repeat(L("."), 60_000), L("b")), F.concat(L(" \n"), F.repeat(L("b \t"), 500_000))
    began = time.monotonic()
    r = row(spark, dots=T.slug(dots, 40), term=T.anchor(F.translate(dots, ".", "-")), clip=T.clip(far, 100_000), slug=T.slug(far, 100_000), cell=T.cell(far, 32_767), sentence=T.first_sentence(F.concat(far, L(". c")), 60))
    assert time.monotonic() - began < 20  # 40,000 stops took slug 33 s when every end of the run was tried
    assert (r.dots, r.term) == ("a" + "." * 39, "a" + "-" * 60_000 + "b")
    assert (r.clip, r.slug) == ("b " * 49_998 + "b…", "b_" * 50_000)
    assert (r.cell, r.sentence) == ((" \n" + "b \t" * 20_000)[:32_766] + "…", "b " * 28 + "b…")
    r = row(
        spark,
        fits=T.clip(L("  ab \n cd  "), 5), over=T.clip(L(" ab \u2003 cd e "), 6), stop=T.first_sentence(L("abcd. ef"), 5), late=T.first_sentence(L("ab cdef. gh"), 5),
        ends=T.slug(L("ab... ___"), 4), inner=T.slug(L("ab... ___c"), 4), ahead=T.slug(L(" ._-ab"), 2), cell=T.cell(L("\x00a\x01\x02b\x00"), 2), cut=T.cell(L("\x00a\x01^b\x00c"), 3), wide=T.cell(L("\U0001d4b3" * 4), 3), none=T.clip(L(None).cast("string"), 3),
    )
    assert (r.fits, r.over, r.stop, r.late) == ("ab cd", "ab…", "abcd.", "ab…")
    assert (r.ends, r.inner, r.ahead) == ("ab", "ab..", "-a")
    assert (r.cell, r.cut, r.wide, r.none) == ("ab", "a^…", "\U0001d4b3" * 2 + "…", None)


def test_markup(spark):
    md = "- *part* **Pump** [a \\[b\\]](x.md) `2.4` <sub>trace: `s#1`</sub> _(generated by M)_ 2*3*4"
    r = row(
        spark,
        esc=T.escape_markdown(L("a*b[c]<d")), back=T.unescape_markdown(L("a\\*b\\[c")), links=T.links_to_labels(L("see [the \\[x\\]](http://y) now")), flat=T.flatten_for_phrases(L("**Head** = `2.4` [L](t) <sub>trace: `q`</sub>")),
        plain=T.markdown_to_plain(L(md)), fm=T.front_matter(F.create_map(L("title"), L('a "b"'), L("kind"), L("x"))), anchor=T.anchor(L("Req A-1!")),
        ids=T.identifiers(L("RWT-REG-002, UTF-8, A-B, xREQ-1 REQ-1x, SYS-REQ-7.")), words=T.subject_words(L("The Pump and a Valve2 of pump")),
        snip=T.mention_snippet(L("x" * 50 + " " + "word " * 30 + "REQ-1 " + "tail " * 40), L("REQ-1"), 20), snip2=T.mention_snippet(L("short"), L("zz")),
    )
    assert (r.esc, r.back, r.links) == ("a\\*b\\[c\\]\\<d", "a*b[c", "see the \\[x\\] now")
    assert r.flat == "head = 2.4 l"
    assert r.plain == "- part Pump a [b] 2.4(generated by M) 2*3*4"
    assert r.fm == '---\ntitle: "a \\"b\\""\nkind: "x"\n---\n' and r.anchor == "req-a-1"
    assert r.ids == ["RWT-REG-002", "SYS-REQ-7"] and r.words == ["pump", "valve2", "pump"]
    assert r.snip == "…word word word REQ-1 tail tail tail…" and r.snip2 == "short"
    back = spark.createDataFrame([(r.fm + "body: x",)], "t string").select(T.read_front_matter(F.col("t")).alias("m")).first().m
    assert back == {"title": 'a "b"', "kind": "x"}


def test_values_and_titles(spark):
    svg = " ".join(f"{b:02x}" for b in b"<?xml version='1'?><svg>") + " 00" * 2000
    r = row(
        spark,
        hex=T.shown_value(L(svg)), long=T.shown_value(L("z" * 5000)), short=T.shown_value(L("ok")), png=T.media_type(F.unhex(L("89504E470D0A"))), gif=T.media_type(F.unhex(L("4749463839"))), none=T.media_type(L(b"hello")),
        t1=T.requirement_title(L("Flow"), L("R-1"), L("text")), t2=T.requirement_title(L(None).cast("string"), L("77"), L("[REQ-1-A] The pump shall " + "run " * 40)), t3=T.requirement_title(L(""), L(""), L("")), t4=T.requirement_title(L("Flow"), L(None).cast("string"), L("x")),
        pm=T.plus_minus(F.array(*map(L, "abcde")), F.array(L("z"))), parted=T.parted_paths(L("A::B::C"), L("A::B::D::E")), parted2=T.parted_paths(L("A"), L("")),
        js=T.reply_json(L('so {"a": 1} ok')), js2=T.reply_json(L("none {x")), f1=T.reply_field(L('{"odd": 3}'), "odd"), f2=T.reply_field(L('{"odd": "B", oops}'), "odd"), f3=T.reply_field(L("no"), "odd"),
        held=T.holds(F.array(F.array(L("a b"), L("zz")), F.array(L("head"))), L("the head a b")), not_held=T.holds(F.array(F.array(L("a b"), L("zz"))), L("a b")), patch=T.patch_sides(L(100), L(20)),
        merged=T.merged_metadata(F.create_map(L("a"), L("1"), L("b"), L("1")), F.create_map(L("b"), L("2"))), classed=T.classed_kind(L("generated"), L("register")), plain_kind=T.classed_kind(L("element"), L("")),
    )
    assert r.hex == f"(SVG image, {len(svg.split()):,} bytes, hex-encoded; not shown)" and r.long.endswith("z… (cut; 5,000 characters in all)") and r.short == "ok"
    assert (r.png, r.gif, r.none) == ("image/png", "image/gif", None)
    assert (r.t1, r.t3, r.t4) == ("Flow (R-1)", "(unnamed)", "Flow") and r.t2.startswith("REQ-1-A: The pump shall run") and r.t2.endswith("run…") and len(r.t2) <= 100
    assert r.pm == " (only here: a, b, c and 2 more; only there: z)" and tuple(r.parted) == ("…::B::C", "…::B::D::E") and tuple(r.parted2) == ("A", "(the root)")
    assert (r.js, r.js2, r.f1, r.f2, r.f3) == ('{"a": 1}', None, "3", "B", None)
    assert r.held and not r.not_held and tuple(r.patch) == (96, 48) and r.merged == {"a": "1", "b": "2"} and (r.classed, r.plain_kind) == ("generated#register", "element")


def test_origins(spark):
    r = row(
        spark,
        d1=O.java_date(L("#Thu Nov 02 11:39:23 PDT 2023\nx=1")), d2=O.java_date(L("#x\n#Thu Nov  2 11:39:23 ZZZ 2023")), d3=O.java_date(L("no date")), utc=O.utc_text(L("2023-11-02T11:39:23-07:00")), day=O.iso_day(L(1)), none=O.iso_day(L(0)),
        i1=O.id_marks(L("_19_0_3_8fe028d_1556123456789_12_3456")), i2=O.id_marks(L("eee_1045467100313_135436_1")), i3=O.id_marks(L("_plain_1")), h=O.id_hash(L("abc")),
        label=O.project_label(L("A very long file name indeed for a model.mdzip"), L("9ffd7a2c00")), label2=O.project_label(L("TMT.MDZIP"), L("sha256:9ffd7a2c00")), loc=O.locator(L("a" * 40), L("e.xmi"), L("_1"), L(7)), loc2=O.locator(L("a" * 40), L(None).cast("string"), L(None).cast("string"), L(0)),
        omg=O.omg_name(L("http://www.omg.org/spec/SysML/20181001/SysML.xmi#SysML_dataType.Real")), omg2=O.omg_name(L("http://www.omg.org/spec/UML/20131001/UML.xmi#_0")), omg3=O.omg_name(L("Other.mdzip#_9")),
        omg4=O.omg_name(L("http://www.omg.org/spec/SysML/2/S.xmi#_SysML_Libraries-x-String_PackageableElement")), lib=O.library_name(L("http://www.omg.org/spec/UML/20131001/PrimitiveTypes.xmi")), lib2=O.library_name(L("http://www.omg.org/spec/UML/20131001/UML.xmi")),
        ext=O.external_label(L("Other.mdzip#_9"), L("Motor")), ext2=O.external_label(L("Other.mdzip#_9")), place=O.found_place(L("/a/in.zip"), F.array(L("m.mdzip")), F.create_map(L("k"), L("v")), L(True)), folder=O.folder_of(L("/a/b/x.zip!m")),
    )
    import hashlib

    assert tuple(r.d1) == ("2023-11-02T11:39:23-07:00", "Thu Nov 02 11:39:23 PDT 2023") and r.d2.iso == "2023-11-02T11:39:23" and tuple(r.d3) == (None, None)
    assert (r.utc, r.day, r.none) == ("2023-11-02T18:39:23", "1970-01-02", None)
    assert tuple(r.i1) == ("8fe028d", 1556123456789) and tuple(r.i2) == (None, 1045467100313) and tuple(r.i3) == (None, None)
    assert r.h == int.from_bytes(hashlib.blake2b(b"abc", digest_size=8).digest(), "little", signed=True)
    assert (r.label, r.label2) == ("A very long file name indeed… [9ffd7a2c]", "TMT [9ffd7a2c]")
    assert (r.loc, r.loc2) == (f"sha256:{'a' * 16}!e.xmi#_1@L7", f"sha256:{'a' * 16}")
    assert (r.omg, r.omg2, r.omg3, r.omg4) == ("Real", "UML", None, "String") and (r.lib, r.lib2) == ("PrimitiveTypes (OMG UML, 20131001)", "UML (OMG, 20131001)")
    assert (r.ext, r.ext2, r.place, r.folder) == ("Motor", "_9", "`in.zip!m.mdzip` (k=v) (input missing)", "/a/b")


def test_packing(spark):
    text = "\n".join(f"line {k} of some words" for k in range(200))
    parts = P.split_parts("Block Pump in A (project X [1])", text)
    assert len(parts) > 3 and all(P.estimate(p) <= P.BUDGET + 12 for p in parts) and parts[1].startswith("Block Pump in A (project X [1]) (part 2 of ")
    assert "\n".join(p.split("\n\n", 1)[1] for p in parts) == text
    assert P.split_parts("H", "") == ["H"] and P.split_parts("H", "one") == ["H\n\none"]
    assert all(P.estimate(p) <= P.BUDGET + 12 for p in P.split_parts("H", "word " * 3000))
    long = P.capped("name " * 300 + "(project X)")
    assert long.endswith(" … (project X)") and P.estimate(long) <= P.HEADING + 4
    context = P.outline_context([0, 1, 2, 1], ["a", "b", "c", "d"])
    assert context == [[], ["- a (continued)"], ["- a (continued)", "  - b (continued)"], ["- a (continued)"]]
    outline = P.split_outline("Thread", [f"  - item {k} of the thread" for k in range(90)], [["- root (continued)"]] * 90, 200)
    assert len(outline) > 2 and all("- root (continued)" in p for p in outline[1:])
    assert P.packed_rows(["word " * 30] * 7, "header", 200, 3) == [1, 1, 1, 2, 2, 2, 3]
    cut = P.split_pieces("Title\n" + "some words " * 100, 300)
    assert all(len(c) <= 300 for c in cut) and cut[0].startswith(f"Title\nPiece: 1 of {len(cut)}\n") and "".join(c.split("\n", 2)[2] for c in cut).replace(" ", "") == ("some words " * 100).replace(" ", "")
    packed = P.repacked(["a", "b", "c"], ["x" * 40, "T\n" + "y " * 80, "z"], 100)
    assert all(len(t) <= 100 for _, t in packed) and packed[0][0][0] == "a" and packed[-1][0][-1] == "c"
    r = row(spark, parts=P.parts(L("H"), L(text)), n=F.size(P.row_parts(F.array(*[L("w " * 50)] * 5), L("h"), 200)), cap=P.cap(L("a b")), cut=P.cut_to_tokens(L("word " * 50), 10), spans=P.spans_text(L("ab cd ef gh"), P.word_offsets(L("ab cd ef gh")), 4, 1), whole=P.spans_text(L("ab cd"), P.word_offsets(L("ab cd")), 4, 1), req=P.requests(F.array(L("a"), L("b")), F.array(L("x"), L("y")), 100))
    assert r.parts == P.split_parts("H", text) and r.n == 5 and r.cap == "a b" and P.estimate(r.cut) <= 10
    assert r.spans == ["ab cd", "cd ef", "ef gh"] and r.whole == ["ab cd"] and [tuple(x) for x in r.req] == [(["a", "b"], "x\n\ny")]


def test_html(spark):
    html = "<html><head><title>t</title></head><body><p>One <b>two</b></p><ul><li>a<ul><li>b</li></ul></li></ul><table><tr><td>1</td><td>2</td></tr></table><img alt='pic'><script>x()</script>end</body></html>"
    assert P.html_text(html) == "One two\n\n- a\n\n  - b\n\n| 1 | 2 |\n\n[image: pic]end"
    assert P.html_text("plain <text>") == "plain <text>" and P.html_text(None) == ""
    r = row(spark, t=P.html_to_text(L(html)), yes=P.is_html(L("  <!DOCTYPE HTML>")), no=P.is_html(L("a <p>")))
    assert r.t == P.html_text(html) and r.yes and not r.no

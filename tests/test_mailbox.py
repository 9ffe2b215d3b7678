"""Names against the greedy rule, multipart mail against the standard library's parser."""

import email
import email.header
import email.policy
import random
from email.mime.application import MIMEApplication
from email.mime.message import MIMEMessage
from email.mime.multipart import MIMEMultipart
from email.mime.text import MIMEText

import pytest
from pyspark.sql import functions as F

from notelake.functions import mime as MM
from notelake.operators import imports as IM
from notelake.operators import mime as MI
from notelake.operators import parts as P
from notelake.operators import sync as SY
from notelake.operators.naming import assign_unique_names
from tests.test_rules import greedy_names


def named(spark, items, existing, ext=True):
    df = spark.createDataFrame([(i, s, e) for i, (s, e) in enumerate(items)], "id long, stem string, ext string")
    ex = spark.createDataFrame([(x,) for x in existing], "name string") if existing is not None else None
    got = assign_unique_names(df, "stem", ["id"], ext="ext" if ext else None, existing=ex, id_col="id").collect()
    by = {r["id"]: r["unique_name"] for r in got}
    assert len(got) == len(items)
    return [by[i] for i in range(len(items))]


@pytest.mark.parametrize("seed", range(3))
def test_names_of_nested_stems_match_greedy(spark, seed):
    rnd = random.Random(seed)
    stems = ["a", "a_1", "a_2", "a_3", "a_9", "a_1_1", "a_1_1_2", "a_01", "a_0", "a_1_", "_1", "", "b", "b_1_1", "b_2"]
    weights = [rnd.choice([1, 1, 4, 12]) for _ in stems]
    items = [(s, rnd.choice(["", ".pdf"])) for s in rnd.choices(stems, weights, k=140)]
    existing = rnd.sample(["a", "a_1", "a_4", "a_5", "b_1", "a.pdf", "a_1_1.pdf", "a_2_1", "a_7.pdf", "zz", "_2"], rnd.randint(0, 8))
    assert named(spark, items, existing) == greedy_names(items, existing)


def test_names_one_root_of_many_children(spark):
    """A root that holds most rows, with children that arrive before and after its own numbers."""
    rnd = random.Random(11)
    items = [("a", "")] * 300 + [(f"a_{k}", "") for k in rnd.sample(range(1, 500), 200) for _ in range(rnd.randint(1, 2))]
    rnd.shuffle(items)
    existing = [f"a_{k}" for k in rnd.sample(range(1, 400), 40)]
    assert named(spark, items, existing) == greedy_names(items, existing)


def test_names_of_a_key_that_repeats_are_an_error(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "id long, stem string")
    with pytest.raises(ValueError, match="not unique"):
        assign_unique_names(df, "stem", ["stem"], id_col="id")


# ---- mail ----------------------------------------------------------------------------------------

def reference_words(raw):
    if not raw:
        return ""
    out = [p.decode(c or "utf-8", "replace") if isinstance(p, bytes) else p for p, c in email.header.decode_header(raw)]
    return " ".join(out).strip()


def test_encoded_words(spark):
    headers = ["plain", "=?utf-8?Q?Caf=C3=A9_au_lait?=", "=?utf-8?Q?Caf=C3=A9?= menu", "Re: =?ISO-8859-1?q?na=EFve?= =?iso-8859-1?Q?=E9?= end",
               "=?utf-8?B?8J+YgCBvaw==?=", "=?utf-8?B?w6k=?=\t=?utf-8?b?w6k?=", "=?utf-8?q?=C3?= =?utf-8?q?=A9?=", "=?windows-1252?Q?=80_=93x=94?=",
               "=?koi8-r?B?8NLJ18XU?=", "a =?utf-8?q?b?= =?latin1?q?=e9?= c", "=?utf-8?x?bad?=", "=? no ?=", "", "=?utf-8?q??= x", "1=2 =?utf-8?q?a=3Db?="]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(headers)], "i int, h string")
    got = {r.i: r.t for r in df.select("i", MM.decoded_words("h").alias("t")).collect()}
    for i, h in enumerate(headers):
        assert got[i] == (reference_words(h) if "=?" in h and h not in ("=?utf-8?x?bad?=", "=? no ?=") else h), h


def reference_message(raw):
    """(plain, html, [(file name, content)]) as the standard library's parser gives them."""
    msg = email.message_from_bytes(raw, policy=email.policy.compat32)
    texts, files = {"text/plain": [], "text/html": []}, []
    for part in msg.walk():
        mark = str(part.get("Content-Disposition", ""))
        data = part.get_payload(decode=True)
        kind = part.get_content_type()
        if msg.is_multipart() and "attachment" in mark:
            name = part.get_filename()
            if name:
                files.append((reference_words(name), data))
            continue
        if not data:
            continue
        if not msg.is_multipart():
            kind = kind if kind == "text/html" else "text/plain"
        if kind in texts:
            try:
                texts[kind].append(data.decode(part.get_content_charset() or "utf-8", "replace"))
            except LookupError:
                pass
    return tuple("\n".join(texts[k]) if texts[k] else None for k in texts), files


def attachment(data, name, **kw):
    part = MIMEApplication(data, **kw)
    part.add_header("Content-Disposition", "attachment", filename=name)
    return part


def generated(rnd):
    """A random message of nested parts."""
    text = lambda: "".join(rnd.choice(["word ", "été ", "=C3 ", "--x", "\n", "\n\n", "line: of text\n", "From here\n"]) for _ in range(rnd.randint(0, 30)))
    def leaf():
        kind = rnd.randrange(6)
        if kind < 3:
            return MIMEText(text(), rnd.choice(["plain", "html"]), rnd.choice(["utf-8", "iso-8859-1", "windows-1252", "utf-8"]))
        if kind == 3:
            part = MIMEText("caf\xe9 = 100%\nsecond line " + "x" * 100, "plain", "iso-8859-1")
            import quopri
            raw = quopri.encodestring(part.get_payload(decode=True))
            part.replace_header("Content-Transfer-Encoding", "quoted-printable")
            part.set_payload(raw.decode("ascii"))
            return part
        name = rnd.choice(["report.pdf", "data.CSV", ("utf-8", "", "naïve file.pdf"), "x.png", "=?utf-8?q?b=C3=A9.pdf?=", "a; b.pdf"])
        return attachment(bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 5, 300]))), name)
    def node(depth):
        if depth == 0 or rnd.random() < 0.4:
            return leaf()
        if rnd.random() < 0.1:
            return MIMEMessage(node(0))
        m = MIMEMultipart(rnd.choice(["mixed", "alternative", "related"]))
        for _ in range(rnd.randint(1, 4)):
            m.attach(node(depth - 1))
        return m
    m = node(3)
    m["Subject"] = "x"
    raw = m.as_bytes()
    if rnd.random() < 0.2 and m.is_multipart():
        raw = raw[:raw.rstrip().rfind(b"\n--")]          # the end boundary is missing
    return raw


HAND = [
    b"Subject: x\n\nplain body",
    b"Subject: x\nContent-Type: text/html\n\n<p>html</p>",
    b"Content-Type: multipart/mixed\n\nno boundary parameter\n",
    b"Content-Type: multipart/mixed; boundary=b\n\nboundary that never comes\n--bb\n",
    b"Content-Type: multipart/mixed; boundary=\"b \"\n\npreamble\n--b\n\nfirst\n--b \t\nContent-Type: TEXT/HTML; charset=\"UTF-8\"\n\n<b>\n--b--\nepilogue\n--b\n\nnot this",
    b"Content-Type: multipart/mixed; boundary=b\n\n--b\n--b\n\n\n--b\nno header here\n\nx\n--b--",
    b"Content-Type: multipart/mixed; boundary=a.b+c(1)\n\n--a.b+c(1)\n\none\n--aXb+c(1)\n--a.b+c(1)--\n",
    b"Content-Type: multipart/mixed; boundary=o\n\n--o\nContent-Type: multipart/alternative;\n boundary=i\n\n--i\n\nin one\n--o\n\nafter a lost end\n--o--\n",
    b"Content-Type: multipart/digest; boundary=d\n\n--d\n\nSubject: inner\n\ninner body\n--d--\n",
    b"Content-Type: text/plain; charset=shift_jis\n\n\x82\xb1\x82\xf1",
    b"Content-Type: text/plain; charset=no-such-charset\n\nlost",
    b"Content-Type: text/plain; charset=us-ascii\n\ncaf\xe9",
    b"Content-Type: application/x-thing\n\nshown as text",
    b"Content-Type: text/plain\nContent-Transfer-Encoding: BASE64\n\naGVs\nbG8\n",
    b"Content-Type: text/plain\nContent-Transfer-Encoding: quoted-printable\n\na=20b=\nc=3D=E9=zz",
    b"Content-Type: multipart/mixed; boundary=b\n\n--b\nContent-Disposition: attachment; filename*0=\"long na\"; filename*1=\"me.pdf\"\n\nabc\n--b\n"
    b"Content-Disposition: attachment; filename*=iso-8859-1''caf%E9.pdf\n\nabc\n--b\nContent-Type: application/pdf; name=typed.pdf\nContent-Disposition: attachment\n\nabc\n--b--",
    b"",
]


def test_multipart_mail_matches_the_standard_parser(spark):
    rnd = random.Random(8)
    raws = HAND + [generated(rnd) for _ in range(250)]
    df = spark.createDataFrame([("f", i, bytearray(r)) for i, r in enumerate(raws)], "file string, seq long, content binary")
    nodes = MI.split_entities(df).cache()
    bodies = {r.seq: (r.plain, r.html) for r in MI.entity_bodies(nodes).collect()}
    files = {}
    for r in MI.entity_attachments(nodes).select("seq", P.part_order().alias("at"), "filename", F.encode("raw", "ISO-8859-1").alias("c")).orderBy("seq", "at").collect():
        files.setdefault(r.seq, []).append((r.filename, bytes(r.c) if r.c is not None else None))
    assert nodes.filter("disposition <> ''").count() > 50 and nodes.agg(F.max(F.size("part_path"))).first()[0] >= 4
    for i, raw in enumerate(raws):
        want, names = reference_message(raw)
        assert bodies.get(i, (None, None)) == want, raw
        assert [(n, c or b"") for n, c in files.get(i, [])] == [(n, c or b"") for n, c in names], raw


def test_import_names_and_counts_attachments(spark):
    def mail(day, subject, *files, label="Inbox"):
        m = MIMEMultipart()
        m["Subject"], m["From"], m["To"], m["Date"], m["X-Gmail-Labels"] = subject, "A <a@x.example>", "b@x.example", f"{day} Feb 2024 10:00:00 +0000", label
        m.attach(MIMEText("body of " + subject))
        for name, data in files:
            m.attach(attachment(data, name))
        return m.as_bytes()
    raws = [mail(1, "one", ("a.pdf", b"1"), ("a.pdf", b"2"), ("b.png", b"3")), mail(1, "=?utf-8?q?caf=C3=A9?=", ("a.pdf", b"4"), ("empty.pdf", b"")),
            mail(1, "spam", ("a.pdf", b"5"), label="Spam"), mail(2, "one", ("a.PDF", b"6"))]
    df = spark.createDataFrame([("f", i, bytearray(r)) for i, r in enumerate(raws)], "file string, seq long, content binary")
    saved = spark.createDataFrame([("2024-02-01_a_1.pdf",)], "name string")
    classified, notes, files = IM.import_mailbox(df, "me", ["Spam"], saved=saved)
    assert {r.seq: (r.outcome, r.attachments) for r in classified.collect()} == {
        0: ("created", 2), 1: ("created", 1), 2: ("skipped_label", 0), 3: ("created", 1)}
    assert sorted((r.out_name, bytes(r.content)) for r in files.collect()) == [
        ("2024-02-01_a.pdf", b"1"), ("2024-02-01_a_2.pdf", b"2"), ("2024-02-01_a_3.pdf", b"4"), ("2024-02-02_a.PDF", b"6")]
    text = {r.seq: r.content for r in notes.collect()}
    assert "**Attachments:** a.pdf, a.pdf, b.png\n" in text[0] and "- [[attachments/2024-02-01_a_2.pdf|a.pdf]]\n" in text[0]
    assert "# café\n" in text[1] and "a.pdf, empty.pdf" in text[1] and "body of" in text[1] and "--=" not in text[1]


# ---- accounts and attachments of one run -----------------------------------------------------------

def test_later_accounts_see_the_notes_of_earlier_ones(spark):
    rows = [(a, f"m{i}", i, [("Subject", s), ("From", "a@x.example"), ("Date", d)], ["INBOX"]) for a, i, s, d in [
        ("one", 1, "hi", "Mon, 1 Jan 2024 10:00:00 GMT"), ("one", 2, "hi", "Mon, 1 Jan 2024 11:00:00 GMT"), ("two", 1, "hi", "Mon, 1 Jan 2024 10:00:00 GMT"),
        ("two", 3, "new", "Mon, 1 Jan 2024 10:00:00 GMT"), ("two", 4, "hi", "no date"), ("one", 5, "hi", "no date")]]
    df = spark.createDataFrame(rows, "account string, message_id string, internal_ms long, headers array<struct<name:string,value:string>>, labels array<string>")
    part = '{"mimeType": "multipart/mixed", "parts": [{"mimeType": "application/pdf", "filename": "f.pdf", "body": {"attachmentId": "x"}}]}'
    df = df.withColumn("payload", F.parse_json(F.lit(part)))
    df = df.withColumn("internal_ms", F.lit(1704103200000).cast("long") + F.col("internal_ms"))
    none = spark.createDataFrame([], "n string")
    args = (["SPAM"], spark.createDataFrame([], "domain string, brand string"), spark.createDataFrame([], "brand string, rank int"), none)
    for accounts, second in ((["one", "two"], "two"), (["two", "one"], "one")):
        classified, notes = SY.sync_accounts(df, accounts, none, *args)
        outcome = {(r.account, r.message_id): r.outcome for r in classified.collect()}
        names = {(r.account, r.message_id): r.name for r in notes.collect()}
        assert len(outcome) == 6 and outcome[second, "m1"] == "skipped_exists"
        assert len(set(names.values())) == len(names) == sum(v == "created" for v in outcome.values())
        if second == "two":
            assert names == {("one", "m1"): "2024-01-01_hi", ("one", "m2"): "2024-01-01_hi_1", ("one", "m5"): "2024-01-01_hi_2",
                             ("two", "m3"): "2024-01-01_new", ("two", "m4"): "2024-01-01_hi_3"}
            kept = [k for k, r in {(r.account, r.message_id): r.content for r in notes.collect()}.items() if "**Saved:**" in r]
            assert kept == [("one", "m1")]         # one file of that name and day is saved, by the first message


def test_inline_text_with_a_file_name_is_body(spark):
    parts = spark.createDataFrame([("a", "m", [0, 0], "text/plain", None, "note.txt", "att", "aGk=", False)],
                                  "account string, message_id string, part_path array<int>, mime string, disposition string, filename string, "
                                  "attachment_id string, data string, has_parts boolean")
    assert [r.plain for r in P.join_parts(parts).collect()] == ["hi"]

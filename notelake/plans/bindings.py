"""Domain inputs derived from the driver's tables.

The reference reads mailboxes, message JSON, notes and spreadsheets. The tables
given to every query are TPC-H-style plus text tables, so each binding below
derives a domain table from them with plain column expressions (no rows are
dropped, sampled or capped). Each Spark binding has a DuckDB twin in
``notelake.plans.oracle`` that computes exactly the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notelake.functions.mail import ntz_to_ms
from notelake.operators.calendar import event_text
from notelake.operators.files import valid_pairs
from notelake.operators.routing import union_accounts
from notelake.session import read_table

# Fixed values used by the bindings.
BASE_TS = "2024-01-01 00:00:00"
AS_OF = "2024-03-01 06:00:00"
LOOKBACK_DAYS = 60
OWN_ADDRESSES = ["team@own.example"]
MAIN_ACCOUNT = "main@own.example"
ALT_ACCOUNT = "alt@own.example"
OFFER_LABEL = "OFFERS"
THREAD_URL = "https://mail.example/#inbox/"


def base_ts() -> F.Column:
    return F.lit(BASE_TS).cast("timestamp_ntz")


def as_of() -> F.Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def _message_rows(conv: DataFrame) -> DataFrame:
    cid, turn, role = F.col("conv_id"), F.col("turn"), F.col("role")
    ts = F.timestamp_add("SECOND", cid * 1800 + turn * 300, base_ts())
    from_hdr = (F.when(role == "assistant", F.lit('"Own Team" <Team@Own.example>'))
                .when(role == "system", F.lit("alerts@service.example"))
                .otherwise(F.format_string('"Contact %d" <contact%d@brand%d.example>',
                                           cid, cid, cid % 20)))
    subject = (F.when(cid % 4 == 0, F.when(turn % 2 == 1, F.concat(F.lit("Late "), cid.cast("string"))))
               .when(turn == 0, F.concat(F.lit("Offer "), cid.cast("string")))
               .otherwise(F.concat(F.lit("Re: Offer "), cid.cast("string"))))
    labels = (F.when(role == "system", F.array(F.lit(OFFER_LABEL), F.lit("INBOX")))
              .when(turn % 3 == 0, F.array(F.lit("INBOX"), F.lit("UNREAD")))
              .otherwise(F.array(F.lit("INBOX"))))
    date_hdr = (F.when(turn % 7 == 3, F.lit(None).cast("string"))
                .when(turn % 11 == 4, F.lit("garbage date"))
                .when(turn % 13 == 6, F.concat(F.date_format(ts, "d MMM yyyy HH:mm:ss"), F.lit(" EST")))
                .when(turn % 5 == 1, F.concat(F.date_format(ts, "d MMM yyyy HH:mm:ss"), F.lit(" -0700")))
                .when(turn % 5 == 2, F.concat(F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0000 (UTC)")))
                .otherwise(F.concat(F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss"), F.lit(" GMT"))))
    body = F.when(turn > 0, F.concat(F.col("text"), F.lit("\n> quoted line\nOn "),
                                     F.date_format(ts, "yyyy-MM-dd"), F.lit(" Contact wrote:\n> earlier text")))\
        .otherwise(F.col("text"))
    return conv.select(
        cid.cast("string").alias("thread_id"),
        F.format_string("%d-%04d", cid, turn).alias("message_id"),
        turn.alias("seq"),
        role,
        ts.alias("ts"),
        ntz_to_ms(ts).alias("internal_ms"),
        from_hdr.alias("from_hdr"),
        F.lit("client@brand.example").alias("to_hdr"),
        subject.alias("subject"),
        date_hdr.alias("date_hdr"),
        labels.alias("labels"),
        body.alias("body"),
        F.translate(F.base64(F.encode(body, "UTF-8")), "+/", "-_").alias("body_b64"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as seen by two mailboxes that both hold every thread."""
    rows = _message_rows(read_table(spark, sf_dir, "conversations"))
    return union_accounts({MAIN_ACCOUNT: rows, ALT_ACCOUNT: rows})


def account_ranks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(MAIN_ACCOUNT, 1), (ALT_ACCOUNT, 2)], "account string, account_rank int")


def senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From-header strings of every shape, one per customer."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 6
    seg = F.lower(F.col("c_mktsegment"))
    user = F.lower(F.translate(F.col("c_name"), "#", "."))
    s = (F.when(k == 0, F.concat(F.lit('"'), F.col("c_name"), F.lit(", "), F.col("c_mktsegment"),
                                 F.lit('" <'), user, F.lit("@"), seg, F.lit(".example>")))
         .when(k == 1, F.concat(F.lit("  "), user, F.lit("@"), F.upper(seg), F.lit(".Example ")))
         .when(k == 2, F.lit(""))
         .when(k == 3, F.concat(F.lit("No Address "), F.col("c_name")))
         .when(k == 4, F.concat(F.lit("x@y@"), seg, F.lit(".example")))
         .otherwise(F.concat(F.col("c_name"), F.lit(" < "), user, F.lit("@"), seg, F.lit(".example >"))))
    return c.select(F.col("c_custkey").alias("id"), s.alias("from_str"))


# Fixed values for the order-derived message stream.
SKIP_LABELS = ["P"]
IMPORT_CUTOFF = "1998-01-01 00:00:00"
SYNC_AS_OF = "2001-08-01 00:00:00"
SYNC_DAYS = 365


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages: account = priority, labels = {status, INBOX}, date =
    order date, subject = priority and sometimes a version with a dot (so up to 8 messages share
    a base name); a price without cents stands for a message whose fetch or parse fails; some
    messages have no account, no date at all, or one that is not from their Date header."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.col("o_orderkey").alias("msg_id"), F.col("o_orderkey").cast("string").alias("message_id"),
        F.when(k % 41 != 0, F.col("o_orderpriority")).alias("account"),
        F.array(F.col("o_orderstatus"), F.lit("INBOX")).alias("labels"),
        F.when(k % 43 != 0, F.col("o_orderdate")).alias("ts"),
        (k % 6 != 0).alias("header_dated"),
        F.when(k % 9 == 0, F.concat(F.col("o_orderpriority"), F.lit(" v1.5"))).otherwise(F.col("o_orderpriority")).alias("subject"),
        (k % 3).alias("attachments"),
        (F.col("o_totalprice") == F.floor("o_totalprice")).alias("failed"),
        F.col("o_orderstatus").alias("status"),
    )


def daily_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label header text per user and day: the day's event types, plus ``Unread``."""
    e = read_table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyy-MM-dd")
    s = e.groupBy("user_id", day.alias("day")).agg(F.array_sort(F.collect_set("event_type")).alias("_set"))
    return s.select("user_id", "day", F.array_join(F.concat(F.col("_set"), F.array(F.lit("Unread"))), " , ")
                    .alias("label_header"))


def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger tabs from orders and customers: finished orders are recurring deals
    (tab per segment and year, brand = segment), the others one-off deals (tab per
    year, brand from the order key); creator = customer name. Cells are strings in
    every shape the sheets hold: blank and header-text creators, alias spellings,
    ``$1,234.56``/``1,234``/``0``/``1.2.3`` rates, several invoice wordings. Machinery tabs drop
    creators with certain words; furniture tabs name their brand in a column."""
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    k = F.col("o_orderkey")
    rec = F.col("o_orderstatus") == "F"
    year = F.year("o_orderdate").cast("string")
    price = F.col("o_totalprice")
    creator = (F.when(k % 97 == 0, F.lit("")).when(k % 89 == 0, F.lit("Client Name"))
               .when(k % 53 == 0, F.lit("https://shop.example")).when(k % 59 == 0, F.lit("Analytics team"))
               .when(k % 11 == 0, F.concat(F.replace(F.col("c_name"), F.lit("Customer#"), F.lit("Cust ")), F.lit(" ")))
               .otherwise(F.col("c_name")))
    own_brand = rec & (F.col("c_mktsegment") == "FURNITURE")
    brand = F.when(~rec | (own_brand & (k % 3 != 0)), F.when(k % 83 == 0, F.lit("")).otherwise(
        F.concat(F.lit("Brand#"), ((k * 7919) % 4001).cast("string"))))
    rate = (F.when(k % 5 == 0, F.concat(F.lit("$"), F.format_string("%.2f", price)))
            .when(k % 5 == 1, F.format_string("%d,%03d", F.floor(price / 1000).cast("long"),
                                              (F.floor(price) % 1000).cast("long")))
            .when(k % 5 == 2, F.lit("")).when(k % 5 == 3, F.lit("0")).otherwise(F.lit("1.2.3")))
    invoice = (F.when(k % 6 == 0, "Paid").when(k % 6 == 1, "Unpaid").when(k % 6 == 2, "Invoice sent")
               .when(k % 6 == 3, "pending").when(k % 6 == 4, ""))
    even = F.year("o_orderdate") % 2 == 0
    return j.select(
        F.when(rec, F.concat(F.lit("REC "), F.col("c_mktsegment"), F.lit(" "), year))
         .otherwise(F.concat(F.lit("ONE-OFF "), year)).alias("tab"),
        F.when(rec, F.col("c_mktsegment")).alias("tab_brand"),
        year.alias("year"),
        F.when(rec, "recurring").otherwise("one-off").alias("kind"),
        F.when(rec & (F.col("c_mktsegment") == "MACHINERY"), F.array(F.lit("http"), F.lit("Analytics"))).alias("drop_words"),
        own_brand.alias("brand_in_column"),
        k.alias("row_no"),
        creator.alias("creator_raw"),
        brand.alias("brand_raw"),
        F.date_format("o_orderdate", "MMMM").alias("month"),
        rate.alias("rate_raw"),
        F.when(rec, F.when(k % 4 == 0, F.lit("")).otherwise(
            F.concat(F.lit("1 reel + "), (k % 3).cast("string"), F.lit(" stories")))).alias("deliverables"),
        F.when(rec | even, F.col("o_orderpriority")).alias("campaign_type"),
        F.when(~rec & ~even, F.col("o_orderpriority")).alias("campaign_type_alt"),
        invoice.alias("invoice_raw"),
        F.when(~rec, F.when(k % 3 == 0, "Approved").when(k % 3 == 1, "pending approval").otherwise(""))
         .alias("approval_raw"),
    )


def ledger_dictionaries(spark: SparkSession, sf_dir: str):
    """Lookup tables: creators = customers in good standing; creator aliases = the
    ``Cust`` spelling of every customer; brands = part brands and segments; brand
    aliases = a fixed map in which ``machinery`` means "no brand link"."""
    c = read_table(spark, sf_dir, "customer")
    p = read_table(spark, sf_dir, "part")
    creators = c.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_name").alias("name"), F.concat(F.lit("rec"), F.col("c_custkey").cast("string")).alias("id"))
    aliases = c.select(F.lower(F.replace(F.col("c_name"), F.lit("Customer#"), F.lit("Cust "))).alias("alias"),
                       F.lower("c_name").alias("name"))
    brands = (p.select(F.col("p_brand").alias("name")).distinct()
              .unionByName(c.select(F.col("c_mktsegment").alias("name")).distinct())
              .select("name", F.concat(F.lit("b_"), F.lower(F.regexp_replace("name", "[^A-Za-z0-9]", ""))).alias("id")))
    brand_aliases = spark.createDataFrame([("machinery", None), ("household", "furniture")],
                                          "alias string, name string")
    return aliases, creators, brand_aliases, brands


def doc_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vault folders from all documents and their whole texts: even ids are files of old
    folders, odd ids of new ones. A file is named by the first characters of its text, so exact
    copies meet at one path with one hash and near copies with another; where two files of a
    folder would share a name, the later one adds its id."""
    d = read_table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    f = d.select(
        "doc_id", F.concat(F.when(F.col("doc_id") % 2 == 0, "old-").otherwise("new-"),
                           (F.floor(F.col("doc_id") / 2) % 3).cast("string")).alias("folder"),
        F.concat(F.lit("n/"), F.substring(F.md5(F.substring(text, 1, 30)), 1, 10)).alias("base"),
        F.octet_length(text).cast("long").alias("length"), F.sha2(text, 256).alias("sha256"))
    first = f.groupBy("folder", "base").agg(F.min("doc_id").alias("first"))
    own = F.when(F.col("doc_id") == F.col("first"), F.col("base")).otherwise(F.concat("base", F.lit("-"), F.col("doc_id").cast("string")))
    return f.join(first, ["folder", "base"]).select(
        "doc_id", "folder", F.concat(own, F.lit(".md")).alias("rel_path"), F.lit(".md").alias("ext"), "length", "sha256")


# Folder pairs as written in the job's arguments (two old folders share a target, one
# old folder does not exist, one has no files, two entries are not pairs).
MERGE_SPECS = ["old-0:new-0", "old-1:new-1", "old-2:new-0", "old-missing:new-missing/sub", "old-empty:new-1", "old-0", "a:b:c"]
EMPTY_FOLDERS = ["old-empty"]


def merge_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid merge pairs."""
    return valid_pairs(spark.createDataFrame([(x,) for x in MERGE_SPECS], "spec string"))


def vault_folders(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Folders that exist: those with files and the empty ones."""
    return files.select("folder").distinct().unionByName(spark.createDataFrame([(x,) for x in EMPTY_FOLDERS], "folder string"))


# Generic brand and ranked keyword -> sub-brand list for the retag job.
GENERIC_BRAND = "Acme"
SUB_BRAND_KEYWORDS = [
    ("red widget", "Acme Red Widgets", 1),
    ("widget", "Acme Widgets", 2),
    ("small ring", "Acme Rings Small", 3),
    ("ring", "Acme Rings", 4),
    ("bolt", "Acme Bolts", 5),
    ("economy", "Acme Value", 6),
]


def part_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notes rendered from parts: parts larger than size 25 link the generic brand."""
    p = read_table(spark, sf_dir, "part")
    brand = F.when(F.col("p_size") > 25, F.lit(GENERIC_BRAND)).otherwise(F.lit("Other"))
    content = F.concat(F.lit('---\ntype: email\nrelated_brand: "'), brand, F.lit('"\n---\n\n# '),
                       F.col("p_name"), F.lit("\n\nAbout [["), brand, F.lit("]] and the "), F.col("p_name"),
                       F.lit(" ("), F.col("p_type"), F.lit(", "), F.col("p_brand"), F.lit(").\n"))
    return p.select(F.concat(F.lit("parts/"), F.col("p_partkey").cast("string"), F.lit(".md")).alias("path"),
                    content.alias("content"))


def keyword_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SUB_BRAND_KEYWORDS, "keyword string, brand string, rank int")


EMAIL_RE = r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+"
# The fixed domain map and the generic (free-mail) domains.
FIXED_DOMAINS = [("src1.example", "Fixed Brand One"), ("mail3.example.com", "Fixed Mail Three")]
GENERIC_DOMAINS = ["mail0.example.com", "src2.example"]


def doc_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mail notes rendered from documents (X17 shape): the sender address is the
    first address in the text, else ``writer<id>@<source>.example``; the sender sits
    in ``from_email``, ``from``, ``sender_email`` or only in the body's From line;
    some notes are captures or plain notes, some have no frontmatter, some end
    with a Related section; ``related_brand`` is empty (followed by another key)."""
    d = read_table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    found = F.regexp_extract("text", EMAIL_RE, 0)
    addr = F.when(found != "", found).otherwise(F.concat(F.lit("writer"), k.cast("string"), F.lit("@"),
                                                         F.col("source"), F.lit(".example")))
    typ = F.when(k % 10 == 7, "Capture").when(k % 10 == 9, "note").otherwise("email")
    sender = (F.when(k % 4 == 0, F.concat(F.lit('from_email: "'), addr, F.lit('"')))
              .when(k % 4 == 1, F.concat(F.lit('from: "Writer '), k.cast("string"), F.lit(" <"), addr, F.lit('>"')))
              .when(k % 4 == 2, F.concat(F.lit("sender_email: "), addr))
              .otherwise(F.lit("account: main")))
    fm = F.concat(F.lit("---\ntype: "), typ, F.lit("\n"), sender, F.lit('\nsubject: "Doc '), k.cast("string"),
                  F.lit('"\nrelated_brand:\nstatus: unprocessed\n---\n\n# Doc '), k.cast("string"),
                  F.lit("\n\n**From:** Writer "), k.cast("string"), F.lit(" <"), addr, F.lit(">\n\n"), F.col("text"),
                  F.lit("\n"), F.when(k % 8 == 5, F.lit("\n## Related\n- [[Old Brand]]\n")).otherwise(F.lit("")))
    content = F.when(k % 25 == 3, F.col("text")).otherwise(fm)
    return d.select(F.concat(F.col("source"), F.lit("/"), k.cast("string"), F.lit(".md")).alias("path"),
                    F.col("source").alias("folder"), content.alias("content"))


def brand_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand profile notes from suppliers: company property (or only an H1, or
    neither), a ``domain``, a ``contact_email`` and a contact table row."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    company = F.when(k % 4 != 0, F.concat(F.lit('company: "'), F.col("s_name"), F.lit('"\n'))).otherwise(F.lit(""))
    h1 = F.when(k % 8 != 0, F.concat(F.lit("# "), F.col("s_name"), F.lit(" Inc\n\n"))).otherwise(F.lit(""))
    content = F.concat(F.lit("---\n"), company,
                       F.lit("domain: src"), (k % 25).cast("string"), F.lit(".example\n"),
                       F.lit("contact_email: sales@mail"), (k % 13).cast("string"), F.lit(".example.com\n---\n"),
                       h1, F.lit("| Name | Email | Role |\n| Rep | rep"), k.cast("string"), F.lit("@partner"),
                       (k % 9).cast("string"), F.lit(".example | Sales |\n"))
    return s.select(F.concat(F.lit("Supplier "), k.cast("string"), F.lit(".md")).alias("file"), content.alias("content"))


def fixed_domains(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIXED_DOMAINS, "domain string, brand string")


def generic_domains(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(g,) for g in GENERIC_DOMAINS], "domain string")


# Fixed values for the notification binding.
NOTIFY_LABEL = "purchase"
NOTIFY_OWN = ["user1@shop.example", "user2@shop.example"]
NOTIFY_POSTED_BEFORE = "2024-01-10 00:00:00"
NOTIFY_LIMIT = 50


def notify_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled messages from events: purchases are the labelled ones; the sender is
    the user; the snippet is the event's properties; every seventh message is in a second
    mailbox as well."""
    e = read_table(spark, sf_dir, "events")
    one = e.filter(F.col("event_type") == NOTIFY_LABEL).select(
        F.format_string("%012d", "event_id").alias("message_id"),
        F.col("ts"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("sender"),
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@shop.example")).alias("sender_email"),
        F.concat(F.lit("Order of "), F.col("value").cast("string")).alias("subject"),
        F.col("props").alias("snippet"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date"),
        F.lit("shop@own.example").alias("account"),
        F.concat(F.lit(THREAD_URL), F.format_string("%012d", "event_id")).alias("url"))
    twice = one.filter(F.col("message_id").cast("long") % 7 == 0).withColumn("account", F.lit("sales@own.example"))
    return one.unionByName(twice)


def notify_posted_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of the previous run: the candidates posted before the state mark."""
    c = notify_candidates(spark, sf_dir)
    return c.filter(F.col("ts") < F.lit(NOTIFY_POSTED_BEFORE).cast("timestamp_ntz")).select("message_id")


# Fixed values for the calendar binding: the time of the run (not midnight), the tag and source
# line, brand rules in order and colours.
CAL_NOW = "2024-01-20 10:00:00"
CAL_TAG = "[CAL]"
CAL_SOURCE = "Source: schedule sheets"
CAL_RULES = [("alpha", "Alpha", 1), ("alpha beta", "Never", 2), ("beta", "Beta", 3), ("one-off", "One-Off", 4), ("one off", "One-Off", 5)]
CAL_COLOURS = [("Alpha", "3"), ("One-Off", "5")]
CAL_COLOUR = "8"


def calendar_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CAL_RULES, "keyword string, brand string, rank int")


def calendar_colours(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CAL_COLOURS, "brand string, colour string")


def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule sheets from events: one sheet per event type (one of them an
    affiliate sheet that the planner skips), the creator named only on some rows
    (filled down), rates with cents, some types and deliverables empty."""
    e = read_table(spark, sf_dir, "events")
    sheet = (F.when(F.col("event_type") == "error", "Affiliate error log")
             .when(F.col("event_type") == "signup", "Alpha Beta signups")
             .when(F.col("event_type") == "purchase", "BETA purchases")
             .when(F.col("event_type") == "click", "One-Off clicks").otherwise("View collabs"))
    k = F.col("event_id")
    day = F.to_date("ts")
    return e.select(
        sheet.alias("sheet"), k.alias("row"),
        F.when(k % 5 == 0, F.concat(F.lit("Creator "), F.col("user_id").cast("string"))).otherwise(F.lit("")).alias("client"),
        F.when(k % 11 != 0, F.upper("event_type")).alias("type"), F.when(k % 13 != 0, F.col("props")).alias("deliverables"),
        F.when(k % 4 == 0, F.lit(0.0)).when(k % 4 != 1, (F.floor(F.col("value") * 1000) / 4).cast("double")).alias("rate"),
        day.alias("reel"),
        F.when(k % 3 == 0, F.lit(None).cast("date")).otherwise(F.date_add(day, 1)).alias("story_1"),
        F.date_add(day, 2).alias("story_2"),
        F.lit(None).cast("date").alias("story_3"),
        F.date_add(day, (k % 4).cast("int")).alias("record"))


def sheet_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sheets with raw cells: reel as text, story 2 as a serial number,
    story 3 as 0 (no date), follow-up as text that is not a date."""
    e = read_table(spark, sf_dir, "events")
    day = F.to_date("ts")
    return e.select(F.col("event_id").alias("row"), F.date_format(day, "yyyy-MM-dd").alias("reel_text"),
                    F.datediff(F.date_add(day, 2), F.lit("1899-12-30").cast("date")).cast("double").alias("story_2_serial"),
                    F.lit(0.0).alias("story_3_serial"), F.lit("not a date").alias("follow_up_text"),
                    F.when(F.col("event_id") % 4 == 0, F.date_format(day, "M/d/yyyy"))
                    .when(F.col("event_id") % 4 == 1, F.date_format(day, "MMM d, yyyy"))
                    .when(F.col("event_id") % 4 == 2, F.date_format(day, "yyyy/MM/dd"))
                    .otherwise(F.date_format(day, "EEE, d MMMM yyyy")).alias("us_text"))


def existing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar events from an earlier sync: reel events of the rows that name their creator,
    some with the text they have now, some with an older one."""
    r = sheet_rows(spark, sf_dir).filter((F.col("row") % 10 == 0) & (F.col("sheet") == "BETA purchases"))
    now_text = event_text(CAL_SOURCE)
    ev = r.withColumn("brand", F.lit("Beta")).withColumn("label", F.lit("Reel"))
    ev = ev.select(F.concat(F.lit(f"{CAL_TAG} "), F.col("client"), F.lit(" - Beta Reel")).alias("title"), F.col("reel").alias("day"),
                   F.when(F.col("row") % 20 == 0, now_text).otherwise(F.lit("older text")).alias("description"), "row")
    return ev.groupBy("title", "day").agg(F.min_by("description", "row").alias("description"))

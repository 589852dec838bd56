"""Template residue, filler, error pages and demands for scripts in place of content (problem 10).

Character n-gram models: one for each kind of residue, fitted on the seed texts below, and one for natural prose, counted over
all texts of the corpus. Windows are lines and sentences; a window's score is the log-likelihood ratio of its n-grams
between the best residue model and prose. A document is excluded when residue windows cover at least `coverage` of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.tables import load

COVERAGE = 0.15  # least part of a text's visible bytes that residue windows cover
BITS, ORDERS = 18, (3, 5)
SHORTEST = 24  # bytes; shorter windows join the next one

# Seed texts of each kind: what servers, frameworks, page builders and form printers are publicly known to print.
FILLER = """
Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.
Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.
Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.
Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.
Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam.
Vestibulum ante ipsum primis in faucibus orci luctus et ultrices posuere cubilia curae. Pellentesque habitant morbi tristique senectus.
Curabitur pretium tincidunt lacus. Nulla gravida orci a odio. Nullam varius, turpis et commodo pharetra, est eros bibendum elit.
This is sample text. This is dummy text. This is placeholder text. Sample content. Dummy content. Filler text. Test content only.
Your content goes here. Your title here. Add your text here. Insert text here. Write something here. Type here. Body text goes here.
Click to edit this text. Double click to edit. Click to add a title. Click to add subtitle. Edit this section. Drag and drop content here.
Hello world! Welcome to your new site. This is your first post. Edit or delete it, then start writing! This is an example page.
This is an example of a page. It is different from a post because it will stay in one place. Just another site. Sample page. Untitled document.
Heading 1 Heading 2 Heading 3 Subheading Paragraph text. Title goes here. Caption goes here. Description goes here. Summary goes here.
test test test test test. testing 000 testing. foo bar baz qux foo bar. asdf asdf asdf. asdfasdf qwerty qwerty. aaa bbb ccc ddd. xxx xxx xxx. blah blah blah.
This text is to be replaced. Please replace this text with your own content. Remove this paragraph before publishing. Do not print this page.
The quick brown fox jumps over the lazy dog. The quick brown fox jumps over the lazy dog. Pack my box with five dozen liquor jugs.
TODO: write this section. TBD. To be decided. To be added. To be announced. To be updated. To be inserted. To be drafted. Details to follow. More to come. Details will be added here.
This section is intentionally left blank. This page intentionally left blank. Text to be supplied. Draft text not final. Content pending. Content will be added soon. Content coming soon.
Test entry. Test record. Test upload. Test file, please delete. Trial entry, please ignore this record. Dummy record for testing of the system. Sample record created for demonstration.
"""
ERRORS = """
404 Not Found. The requested URL was not found on this server. Error 404. Page not found. The page you are looking for could not be found.
The page you requested does not exist or has been moved. Sorry, we couldn't find that page. Oops! That page can't be found. Nothing was found at this location.
HTTP Status 404 - Not Found. HTTP Status 500 - Internal Server Error. HTTP Error 503. The service is unavailable. HTTP Error 400. Bad Request - Invalid URL.
403 Forbidden. You don't have permission to access this resource. Access denied. You are not authorized to view this page. Access to this resource is denied.
500 Internal Server Error. The server encountered an internal error or misconfiguration and was unable to complete your request. Please contact the server administrator.
502 Bad Gateway. 503 Service Unavailable. 504 Gateway Time-out. 410 Gone. 401 Unauthorized. 429 Too Many Requests. nginx/0.00.0. Apache/0.0.00 Server at localhost Port 00.
The server is temporarily unable to service your request due to maintenance downtime or capacity problems. Please try again later. The upstream server is not responding.
This site can't be reached. The connection was reset. The connection has timed out. The server took too long to respond. Connection refused. Request timed out.
Unable to connect to the database. Error establishing a database connection. Could not connect to server. Service temporarily down. We are down for maintenance. Back soon.
An unexpected error has occurred. An error occurred while processing your request. Something went wrong. Please try again. If the problem persists, contact support. Error code: 0x000000
Server Error in '/' Application. Runtime Error. Object reference not set to an instance of an object. Stack trace: at System.Web.UI.Page
Traceback (most recent call last): File "app.py", line 00, in <module> raise ValueError KeyError: 'id' TypeError: 'NoneType' object is not subscriptable AttributeError
Exception in thread "main" java.lang.NullPointerException at org.example.Main.main(Main.java:00) Caused by: java.io.IOException: Broken pipe ... 00 more
Fatal error: Uncaught Error: Call to undefined function in /var/www/html/index.php on line 00. Warning: include(): Failed opening. Notice: Undefined index
You have an error in your SQL syntax; check the manual. ORA-00000: invalid identifier. SQLSTATE[00000]: General error. mysql_connect(): Access denied for user. Deadlock found
<?xml version="0.0" encoding="UTF-0"?><Error><Code>AccessDenied</Code><Message>Access Denied</Message><RequestId>00</RequestId><HostId>00</HostId></Error> <Code>NoSuchKey</Code>
{"error": "not found", "status": 404, "message": "Resource not found"} {"code":500,"message":"Internal error"} null undefined NaN [object Object] undefined undefined null null
Your session has timed out. Your session has expired. Please log in again to continue. Please sign in to view this content. Login required. You must be logged in. Session expired, please sign in.
Your IP address has been blocked. Too many requests from your address. You have been rate limited. Request blocked by the firewall. Your request could not be satisfied. Request ID: 00000000
No results found. Your search did not match any documents. No records found. There are no items to display. Try different keywords. Please refine your search. Try another search. 0 results.
The file could not be opened. The file is damaged and could not be repaired. Failed to load document. Unable to load PDF. The document is no longer available. File not found. Download failed. Invalid file.
This website is under construction. Site under construction. Under maintenance. We will be back shortly. Coming soon. This domain is parked. This link has expired. This link is broken. Invalid link.
Go back to the home page. Return to homepage. Go to home. Back to previous page. Contact the webmaster. Report this problem. Home > Error. Home | Search | Contact us | Sitemap | Help
"""
SCRIPTS = """
Please enable JavaScript to view this page. You need to enable JavaScript to run this app. JavaScript is disabled in your browser. JavaScript is required. JavaScript must be enabled.
This site requires JavaScript. Please turn JavaScript on and reload the page. Enable JavaScript and cookies to continue. We're sorry but this app doesn't work properly without JavaScript enabled. Please enable it to continue.
Your browser does not support JavaScript. Your browser has scripts turned off. Scripting is disabled. Turn on scripts in your browser settings and refresh. Active scripting needs to be enabled. Allow scripts for this site.
<noscript>Your browser does not support JavaScript!</noscript> <noscript>Please enable scripts to use this website.</noscript> <script>window.location="/";</script> function(){ var d = document.createElement("script"); }
This page uses scripts to display its contents. The contents can't be shown because scripts are blocked. The application could not start because scripts are turned off. The viewer needs scripts to work.
Your browser is out of date. Please upgrade your browser. This browser is not supported. Use a modern browser such as Chrome, Firefox or Edge. Update your browser to view this site properly.
Checking your browser before accessing the site. This process is automatic. Your browser will redirect to your requested content shortly. Please allow up to 0 seconds. DDoS protection. Ray ID: 00000000
Just a moment... Verifying you are human. This may take a few seconds. Please complete the security check to access the site. I'm not a robot. Are you a robot? Complete the captcha. Select all images.
Please enable cookies. Cookies are disabled. This site uses cookies. We use cookies to improve your experience. Accept cookies. Accept all. Reject all. Manage preferences. Cookie settings.
Loading... Please wait... Loading, please wait. Please wait while the page loads. Redirecting... You are being redirected. If you are not redirected automatically, click here. The page will load shortly.
Adobe Flash Player is required. Please install the plugin to view this content. Java is required to view this document. The viewer requires a plugin that is not installed. Download the latest version.
window.__INITIAL_STATE__ = {"user":null,"items":[]}; self.__next_f.push([0]); document.getElementById("root"); data-reactroot __NEXT_DATA__ {"props":{"pageProps":{}}} webpackJsonp
"""
# The marks that enclose an unfilled field, fields, and the lines of forms.
BRACKETS = ["{{%s}}", "{{ %s }}", "{%s}", "${%s}", "<<%s>>", "<%s>", "[%s]", "[insert %s]", "[enter %s here]", "«%s»", "%%%s%%", "#%s#", "__%s__", "[[%s]]", "@@%s@@", "{%% %s %%}", "<%%= %s %%>", "[%s to be filled in]"]
FIELDS = ["name", "first name", "full name", "client name", "applicant name", "party name", "plaintiff", "defendant", "court", "judge", "case no", "file number", "date", "start date", "due date",
          "address", "city", "phone", "email", "amount", "total", "title", "subject", "body", "reference", "description", "signature", "company", "position", "section", "act"]
FORMS = [
    "Dear {0}, thank you for {1}.", "To: {2} From: {3} Date: {12} Subject: {22}", "This agreement is made on {12} between {5} of {15} and {3} of {16}.",
    "Name: {2} Address: {15} Phone: {17} Email: {18}", "In the {8} of {16} Case No. {10} {6} versus {7}", "Before {9} on {12}", "{6} v. {7}", "Judgment of {8} dated {12}.",
    "I, {2}, of {15}, state that {25}.", "The sum of {19} is due on {14}.", "Signed {26} for {27}, {28}.", "Section {29} of {30}", "{21} {23} {24}", "Order in {10}: {23}", "Application {11} filed by {4} on {12} is {23}.",
]
BLANKS = [
    "Name: ____________________ Date: ____________", "Signature: _______________________", "Case No. ________ of ________", "Address ______________________________________", "Telephone: ____________",
    "I, ____________________, son of ____________________, hereby declare that ____________________", "on this ______ day of ____________, ______", "Rs. ____________ (Rupees ____________________ only)",
    "Name ............................ Age ........ Address ............................", "dated ................ at ................", "between .................... and ....................",
    "Date: DD/MM/YYYY", "Date: __/__/____", "Name: XXXXXXXXXX", "No. XXX/XXXX", "Mr. XXXX XXXX of XXXXXX", "Amount: Rs. XX,XXX", "( ) Yes ( ) No", "[ ] Yes [ ] No", "Tick one: [ ] [ ]",
]


def _styles(name: str) -> list[str]:
    """A field's spellings: spaced, upper case, joined by underscores, joined capitals."""
    return [name, name.upper(), name.replace(" ", "_"), name.upper().replace(" ", "_"), "".join(w.capitalize() for w in name.split())]


def template_seeds() -> list[str]:
    out = list(BLANKS) * 8
    for mark in BRACKETS:
        for style in range(5):
            fields = [mark % _styles(f)[style] for f in FIELDS]
            out += [form.format(*fields) for form in FORMS]
    return out


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[48:58] = 48
_LOWER[[9, 13]] = 32


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """The hash of the `order` bytes that start at each byte (in BITS bits)."""
    h = np.zeros(len(data), np.uint64)
    padded = np.concatenate([data, np.full(order, 32, np.uint8)]).astype(np.uint64)
    for k in range(order):
        h = h * np.uint64(0x100000001B3) + padded[k : k + len(data)] + np.uint64(1)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x9E3779B97F4A7C15 + order * 2)
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def cut_windows(text: str) -> tuple[np.ndarray, list[int]]:
    """The folded bytes of a text (lower case, digits as 0) and the starts of its windows; lines and sentences, short ones joined."""
    data = _LOWER[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    if not len(data):
        return data, []
    after = np.flatnonzero((data[:-1] == 10) | (np.isin(data[:-1], (46, 33, 63)) & (data[1:] <= 32))) + 1
    starts = [0]
    for at in after.tolist():
        if at - starts[-1] >= SHORTEST:
            starts.append(at)
    if len(starts) > 1 and len(data) - starts[-1] < SHORTEST:
        starts.pop()
    data = data.copy()
    data[data == 10] = 32
    return data, starts


THRESHOLD = 1.0  # of a window's log-likelihood ratio a byte, summed over the orders
MIXED = 0.5  # the part of residue text that its seeds make up
PROSE_WEIGHT, LEAST = 2e5, 0.01
KINDS = ("template", "filler", "error", "script")


class ResidueModel:
    """Log-likelihood ratios of n-grams: for each n-gram order a table of 2^BITS rows and a column per kind of residue."""

    KINDS = KINDS

    def __init__(self, tables: np.ndarray):
        self.tables = tables  # orders x 2^BITS x kinds, float32

    def score(self, texts: list[str | None]) -> tuple[list[list[tuple[int, int, float, int]]], list[int]]:
        """For each text: its windows (start, end, ratio a byte, kind), and its bytes that aren't blank."""
        cut = [cut_windows(t or "") for t in texts]
        data = np.concatenate([c[0] for c in cut]) if cut else np.zeros(0, np.uint8)
        visible = np.concatenate([[0], np.cumsum(data > 32)])
        base = np.concatenate([[0], np.cumsum([len(c[0]) for c in cut])]).astype(np.int64)
        shown = (visible[base[1:]] - visible[base[:-1]]).tolist()
        starts = np.concatenate([b + np.array(c[1], np.int64) for b, c in zip(base, cut)]) if cut else np.zeros(0, np.int64)
        if not len(starts):
            return [[] for _ in texts], shown
        ends = np.append(starts[1:], len(data))
        # n-grams that run over the window's end belong to no window
        last = np.maximum(starts + 1, ends - max(ORDERS) + 1)
        ratio = sum(self.tables[j][grams(data, o)] for j, o in enumerate(ORDERS))
        bounds = np.stack([starts, last], 1).ravel()
        if bounds[-1] >= len(data):
            ratio = np.concatenate([ratio, np.zeros((1, len(KINDS)), np.float32)])
        r = np.add.reduceat(ratio, bounds, axis=0)[::2] / (last - starts)[:, None]
        kind = r.argmax(1)
        rows = list(zip(visible[starts].tolist(), visible[ends].tolist(), r.max(1).tolist(), kind.tolist()))
        out, at = [], 0
        for c in cut:
            out.append(rows[at : at + len(c[1])])
            at += len(c[1])
        return out, shown


def seed_texts() -> dict[str, list[str]]:
    return dict(zip(KINDS, [template_seeds(), FILLER.strip().split("\n"), ERRORS.strip().split("\n"), SCRIPTS.strip().split("\n")]))


def seed_counts(seeds: dict[str, list[str]]) -> list[np.ndarray]:
    """For each n-gram order a table (2^BITS x kinds) of the seeds' n-grams."""
    out = [np.zeros((1 << BITS, len(KINDS))) for _ in ORDERS]
    for k, texts in enumerate(seeds.get(kind, []) for kind in KINDS):
        data = _LOWER[np.frombuffer("\n".join(texts).encode(), np.uint8)].copy()
        data[data == 10] = 32
        for j, o in enumerate(ORDERS):
            out[j][:, k] = np.bincount(grams(data, o), minlength=1 << BITS)
    return out


def fitted(prose: list[np.ndarray], seeds: dict[str, list[str]] | None = None) -> ResidueModel:
    """The model of the seeds against the counted n-grams of prose (for each order an array of 2^BITS counts).

    Residue is taken as a mixture of its seeds and prose (MIXED), so that ordinary words beside a placeholder count little
    against it; prose counts are taken relative to a fixed weight, so that a corpus of any size weighs alike.
    """
    tables = []
    for own, all_of in zip(seed_counts(seeds or seed_texts()), prose):
        p = own / np.maximum(1.0, own.sum(0))
        every = all_of * (PROSE_WEIGHT / max(1.0, all_of.sum()))
        q = ((every + LEAST) / (every.sum() + LEAST * (1 << BITS)))[:, None]
        tables.append(np.clip(np.log((MIXED * p + (1 - MIXED) * q) / q), -8, 8).astype(np.float32))
    return ResidueModel(np.stack(tables))


def count_grams(texts: list[str | None]) -> list[np.ndarray]:
    """For each order the counts of the n-grams that lie within a text."""
    data = [_LOWER[np.frombuffer(t.encode("utf-8", "replace"), np.uint8)] for t in texts if t]
    flat = np.concatenate(data) if data else np.zeros(0, np.uint8)
    flat = np.where(flat == 10, np.uint8(32), flat)
    sizes = np.array([len(d) for d in data], np.int64)
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))  # bytes from here to the text's end
    return [np.bincount(grams(flat, o)[room >= o], minlength=1 << BITS) for o in ORDERS]


def fit(texts: list[str], seeds: dict[str, list[str]] | None = None) -> ResidueModel:
    """The model over texts at hand, for tests and small uses."""
    return fitted([c.astype(float) for c in count_grams(texts)], seeds)


SLICES = 64  # parts of the count tables that are summed apart


def _added(frames: pd.DataFrame) -> bytes:
    total = np.zeros(len(ORDERS) * (1 << BITS) // SLICES, np.int64)
    for c in frames["counts"]:
        total += np.frombuffer(c, np.int64)
    return total.tobytes()


def corpus_counts(df: DataFrame, text: str = "text") -> list[np.ndarray]:
    """The n-gram counts of every text of df. Each task counts into tables of a fixed size; slices of them are summed in two
    steps, groups of tasks first, so that no step gathers more than the square root of the tasks. The driver gets one table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(1 << BITS, np.int64) for _ in ORDERS]
        for b in batches:
            for at in range(0, b.num_rows, 64):
                for have, more in zip(total, count_grams(b.column(0).slice(at, 64).to_pylist())):
                    have += more
        flat = np.concatenate(total)
        task = TaskContext.get().partitionId()
        parts = [p.tobytes() for p in np.split(flat, SLICES)]
        yield pa.RecordBatch.from_pydict({"slice": pa.array(range(SLICES), pa.int32()), "task": pa.array([task] * SLICES, pa.int32()), "counts": pa.array(parts, pa.binary())})

    def add(key: tuple, g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": [key[0]], "counts": [_added(g)]})

    made = df.select(text).mapInArrow(count, "slice int, task int, counts binary")
    wide = max(1, int(max(1, df.rdd.getNumPartitions()) ** 0.5))
    some = made.groupBy("slice", F.pmod("task", F.lit(wide)).alias("lot")).applyInPandas(add, "slice int, counts binary")
    rows = some.groupBy("slice").applyInPandas(add, "slice int, counts binary").collect()  # SLICES rows of a fixed size
    if not rows:  # a table without partitions
        return [np.zeros(1 << BITS) for _ in ORDERS]
    flat = np.concatenate([np.frombuffer(r.counts, np.int64) for r in sorted(rows, key=lambda r: r["slice"])])
    return [p.astype(float) for p in np.split(flat, len(ORDERS))]


def fit_on(df: DataFrame, text: str = "text") -> ResidueModel:
    """The model of the seeds against the prose statistics of all texts of df."""
    return fitted(corpus_counts(df, text))


def judge(df: DataFrame, fitted_model: ResidueModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, residue_share (0 to 1), kind (the kind that covers most, null where none): one row per row of df.

    Null, empty and blank texts have share 0. Repeated rows and null keys are kept. Whole texts are scored.
    """
    kind = df.schema[key].dataType.simpleString()
    shared = df.sparkSession.sparkContext.broadcast(fitted_model.tables)  # a fixed number of bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ResidueModel(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 64):
                part = b.slice(at, 64)
                windows, visible = m.score(part.column(1).to_pylist())
                share, kinds = [], []
                for rows, n in zip(windows, visible):
                    by = [0] * len(m.KINDS)
                    for a, z, r, k in rows:
                        if r > THRESHOLD:
                            by[k] += z - a
                    share.append(sum(by) / n if n else 0.0)
                    kinds.append(m.KINDS[int(np.argmax(by))] if any(by) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(share, pa.float64()), pa.array(kinds, pa.string())], names=["k", "s", "c"])

    return df.select(df[key].alias("k"), df[text].alias("t")).mapInArrow(run, f"k {kind}, s double, c string").toDF(key, "residue_share", "kind")


def p10_shares(spark: SparkSession, d: str) -> DataFrame:
    docs = load(spark, d, "documents")
    return judge(docs, fit_on(docs))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_shares(spark, d).filter(F.col("residue_share") >= COVERAGE).select("doc_id")


def p10_kept(spark: SparkSession, d: str) -> DataFrame:
    """doc_id of the documents that stay: those with a text that isn't excluded."""
    return p10_shares(spark, d).filter(F.col("residue_share") < COVERAGE).select("doc_id")


QUERIES = {"p10_found": p10_found, "p10_shares": p10_shares, "p10_kept": p10_kept}
SQL: dict[str, str] = {}

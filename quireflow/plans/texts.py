"""Identity, source and text queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators.pages import line_accuracy
from ..sources import lists
from .registry import query


def values(e, rows: list[tuple], schema: str) -> DataFrame:
    return e.spark.createDataFrame(rows, schema)


def points(hexes: str) -> str:
    """A text by the numbers of its code points; a slash is a space."""
    return "".join(" " if p == "/" else chr(int(p, 16)) for p in hexes.split())


# --- sources and identity


@query("s01_manifest_filter", "SELECT page_id, name FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'p.JPG' WHEN 1 THEN 'd/p.jpg' WHEN 2 THEN 'noext' ELSE file END AS name FROM page_output) WHERE regexp_full_match(lower(name), '[^/]*[.](jpg|jpeg|png|tif|tiff)')")
def manifest_filter(e) -> DataFrame:
    name = F.when(F.col("page_id") % 4 == 0, "p.JPG").when(F.col("page_id") % 4 == 1, "d/p.jpg").when(F.col("page_id") % 4 == 2, "noext").otherwise(F.col("file"))
    return e.page_output.select("page_id", name.alias("name")).where(lists.is_image(F.col("name")))


@query("s03_source_routing", "SELECT volume_id, s AS source, CASE WHEN s = 'archive' THEN w_id ELSE s || ':' || w_id END AS db_w_id FROM (SELECT volume_id, w_id, coalesce(lower(trim(CASE volume_id % 3 WHEN 0 THEN ' ARCHIVE ' WHEN 1 THEN 'benchmark' END)), 'archive') AS s FROM volumes)")
def source_routing(e) -> DataFrame:
    raw = F.when(F.col("volume_id") % 3 == 0, " ARCHIVE ").when(F.col("volume_id") % 3 == 1, "benchmark")
    return lists.routed(e.volumes.withColumn("source", raw).withColumn("i_version", F.lit("v1"))).select("volume_id", "source", "db_w_id")


@query(
    "s05_message_parse",
    """SELECT message_id, CASE WHEN message_id % 3 = 0 THEN 'W' || worker_id ELSE 'Wb' || message_id END AS w_id, CASE WHEN message_id % 5 = 0 THEN 'I' || worker_id ELSE 'Ib' || message_id END AS i_id,
    CASE WHEN message_id % 2 = 0 THEN 'benchmark' END AS source, CASE WHEN message_id % 2 = 0 THEN '7' END AS i_version FROM messages""",
)
def message_parse(e) -> DataFrame:
    """Attributes win over the JSON body, field by field; a body that isn't JSON counts as empty."""
    m, sid = F.col("message_id"), F.col("worker_id").cast("string")
    attribute = F.map_filter(F.create_map(F.lit("w_id"), F.when(m % 3 == 0, F.concat(F.lit("W"), sid)), F.lit("i_id"), F.when(m % 5 == 0, F.concat(F.lit("I"), sid)), F.lit("source"), F.when(m % 2 == 0, " Benchmark ")), lambda k, v: v.isNotNull())
    body = F.when((m % 3 == 0) & (m % 5 == 0), F.when(m % 2 == 0, '{"i_version": 7}').otherwise("{not json")).otherwise(
        F.to_json(F.struct(F.concat(F.lit("Wb"), m.cast("string")).alias("w_id"), F.concat(F.lit("Ib"), m.cast("string")).alias("i_id"), F.when(m % 2 == 0, "other").alias("source"), F.when(m % 2 == 0, "7").alias("i_version")))
    )
    return lists.parsed_messages(e.messages.select("message_id", attribute.alias("attributes"), body.alias("body"))).select("message_id", "w_id", "i_id", "source", "i_version")


@query("s17_label_lines", """WITH t AS (SELECT page_id, idx, CASE WHEN idx % 3 = 0 THEN cls || '.0' WHEN idx % 7 = 6 THEN '9' ELSE CAST(cls AS VARCHAR) END AS c, x, y, CASE WHEN idx % 5 = 4 THEN 'bad' ELSE CAST(w AS VARCHAR) END AS w, h FROM boxes)
    SELECT page_id, idx, CAST(CAST(c AS DOUBLE) AS INTEGER) AS cls, ['header', 'text-area', 'footnote', 'footer'][CAST(CAST(c AS DOUBLE) AS INTEGER) + 1] AS label, TRY_CAST(w AS DOUBLE) AS w FROM t WHERE TRY_CAST(w AS DOUBLE) > 0 AND CAST(c AS DOUBLE) < 4""")
def label_lines(e) -> DataFrame:
    c = F.when(F.col("idx") % 3 == 0, F.concat(F.col("cls").cast("string"), F.lit(".0"))).when(F.col("idx") % 7 == 6, "9").otherwise(F.col("cls").cast("string"))
    w = F.when(F.col("idx") % 5 == 4, "bad").otherwise(F.col("w").cast("string"))
    lines = e.boxes.select("page_id", "idx", F.concat_ws(" ", c, F.col("x").cast("string"), F.col("y").cast("string"), w, F.col("h").cast("string")).alias("value"))
    return lists.parsed_labels(lines).select("page_id", "idx", "cls", "label", "w")


def _responses(e) -> DataFrame:
    """Files of recognition responses for the pages: eight pages a file, each sixth page once more in the next, some without a known address."""
    p = F.col("page_id")
    lang = lambda code, c: F.struct(code.alias("languageCode"), c.alias("confidence"))
    own = F.array(lang(F.col("lang"), (p % 10) / 10), lang(F.lit("und"), F.lit(0.35)))
    word = lambda c: F.struct(c.cast("double").alias("confidence"))
    paragraph = F.struct(F.struct(F.when(p % 2 == 1, F.array(lang(F.lit("und"), F.lit(0.2)))).alias("detectedLanguages")).alias("property"), F.when(p % 4 != 3, F.array(word((p % 7) / 10), word((p % 5) / 10), word(F.lit(0.5)))).alias("words"))
    block = F.struct(F.struct(F.when(p % 2 == 1, own).alias("detectedLanguages")).alias("property"), F.array(paragraph).alias("paragraphs"))
    page = F.struct(F.struct(F.when(p % 2 == 0, own).alias("detectedLanguages")).alias("property"), F.array(block).alias("blocks"))
    annotation = lambda text: F.struct(text.alias("text"), F.array(page).alias("pages"))
    uri = F.when(p % 50 == 1, "gs://elsewhere/x.jpg").otherwise(F.concat(F.lit("gs://pages/"), "file"))
    one = lambda file, text: e.page_output.select(file.alias("f"), p.alias("k"), F.struct(F.struct(uri.alias("uri")).alias("context"), annotation(text).alias("fullTextAnnotation")).alias("r"))
    every = one(F.expr("page_id div 8"), F.col("page_text")).union(one(F.expr("page_id div 8 + 1"), F.lit("again")).where("k % 6 = 0"))
    return every.groupBy("f").agg(F.array_sort(F.collect_list(F.struct("k", "r"))).alias("rs")).select(F.lpad(F.col("f").cast("string"), 8, "0").alias("file"), F.to_json(F.struct(F.col("rs.r").alias("responses"))).alias("value"))


@query(
    "s19_a15_a16_responses",
    """SELECT page_id, CAST(1 AS INTEGER) AS nb_pages, CAST(length(page_text) AS BIGINT) AS text_len, CASE WHEN (page_id % 10) / 10.0 > 0.35 THEN lang || ',und' WHEN page_id % 2 = 0 OR (page_id % 10) / 10.0 < 0.35 THEN 'und,' || lang END AS languages,
    CASE WHEN page_id % 4 = 3 THEN 0.0 ELSE list_median([(page_id % 7) / 10.0, (page_id % 5) / 10.0, 0.5]) END AS confidence FROM page_output WHERE page_id % 50 <> 1""".replace("list_median(", "list_aggregate(").replace("0.5])", "0.5], 'median')"),
)
def responses(e) -> DataFrame:
    """The rows of the pages for which a response came, the first of several."""
    pages = e.page_output.select("page_id", F.concat(F.lit("gs://pages/"), "file").alias("uri"))
    found = lists.matched_responses(lists.parsed_responses(_responses(e)), pages)
    return found.select("page_id", "nb_pages", "text_len", F.array_join("languages", ",").alias("languages"), "confidence")


@query(
    "t14_uri_parts",
    """SELECT volume_id, CASE volume_id % 3 WHEN 0 THEN 's3' WHEN 1 THEN 'gs' ELSE 'file' END AS scheme, CASE WHEN volume_id % 3 < 2 THEN 'bucket-' || volume_id % 7 ELSE '' END AS bucket,
    CASE volume_id % 3 WHEN 2 THEN '/data/' ELSE '' END || w_id || '/' || i_id || CASE volume_id % 3 WHEN 2 THEN '/a b' ELSE '/' || 'a.jpg' END AS key, CASE volume_id % 3 WHEN 0 THEN 's3://bucket-' || volume_id % 7 || '/p' WHEN 1 THEN 'file:///plain/p' ELSE 'file:///data' END || '/a.jpg' AS joined FROM volumes""",
)
def uri_parts(e) -> DataFrame:
    v, at = F.col("volume_id") % 3, F.concat("w_id", F.lit("/"), "i_id")
    bucket = F.concat(F.lit("bucket-"), (F.col("volume_id") % 7).cast("string"))
    uri = F.when(v == 0, F.concat(F.lit("s3://"), bucket, F.lit("//"), at, F.lit("/a.jpg"))).when(v == 1, F.concat(F.lit("gs://"), bucket, F.lit("/"), at, F.lit("/a.jpg"))).otherwise(F.concat(F.lit("file:///data/"), at, F.lit("/a%20b")))
    base = F.when(v == 0, F.concat(F.lit("s3://"), bucket, F.lit("/p//"))).when(v == 1, "/plain/p").otherwise("file:///data/")
    return e.volumes.select("volume_id", T.uri_parts(uri).alias("u"), T.joined_uri(base, F.lit("a.jpg")).alias("joined")).select("volume_id", "u.*", "joined")


@query("t15_artifact_names", "SELECT volume_id, CASE WHEN volume_id % 5 <> 0 THEN w_id END AS w_id, CASE WHEN volume_id % 5 <> 0 THEN i_id END AS i_id FROM volumes")
def artifact_names(e) -> DataFrame:
    version = F.when(F.col("volume_id") % 3 == 0, "V2x").otherwise(T.version_of(F.concat(F.lit('"'), "last_etag", F.lit('-2"'))))
    name = F.concat(F.when(F.col("volume_id") % 2 == 0, "s3://b/k/").otherwise(""), "w_id", F.lit("-"), "i_id", F.lit("-"), version, F.when(F.col("volume_id") % 5 == 0, ".json").otherwise(".parquet"))
    return e.volumes.select("volume_id", T.artifact_name(name).alias("n")).select("volume_id", "n.w_id", "n.i_id")


@query("t16_d01_etag_bytes", "SELECT volume_id, last_etag AS hex, 16 AS size, CASE WHEN volume_id % 3 = 0 THEN last_etag || '-3' ELSE last_etag END AS plain, substr(last_etag, 1, 6) AS version FROM volumes")
def etags(e) -> DataFrame:
    v = F.col("volume_id") % 3
    raw = F.when(v == 0, F.concat(F.lit('"'), "last_etag", F.lit('-3"'))).otherwise(F.col("last_etag"))
    bytes_ = T.etag_bytes(F.when(v == 1, F.upper(raw)).otherwise(raw))
    return e.volumes.select("volume_id", bytes_.alias("b"), T.plain_etag(raw).alias("plain"), T.version_of(raw).alias("version")).select("volume_id", F.lower(F.hex("b")).alias("hex"), F.octet_length("b").alias("size"), "plain", "version")


@query("t17_d04_folder_prefix", "SELECT volume_id, 'Works/' || substr(md5(w_id), 1, 2) || '/' || w_id || '/images/' || w_id || '-' || CASE WHEN volume_id % 2 = 0 THEN lpad(CAST(volume_id % 10000 AS VARCHAR), 4, '0') ELSE i_id END || '/' AS prefix FROM volumes")
def prefixes(e) -> DataFrame:
    i = F.when(F.col("volume_id") % 2 == 0, F.concat(F.lit("I"), F.lpad((F.col("volume_id") % 10000).cast("string"), 4, "0"))).otherwise(F.col("i_id"))
    return e.volumes.select("volume_id", T.folder_prefix(F.col("w_id"), i).alias("prefix"))


@query("t18_s04_volume_arguments", "SELECT w_id, i_id, coalesce(source, 'archive') AS source, version FROM (VALUES ('W22084', 'I0886', NULL, NULL), ('W22084', 'I0887', NULL, NULL), ('W12345', 'I0123', 'benchmark', '202603')) t(w_id, i_id, source, version)")
def volume_arguments(e) -> DataFrame:
    lines = ["W22084,I0886", "W22084 I0887", "", "# comment", "alone", "W12345,I0123,Benchmark,202603", "a,b,c,d,e"]
    return lists.parsed_volumes(values(e, [(x,) for x in lines], "value string"))


@query("t19_safe_ids", "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN 'page' ELSE substr(regexp_replace(url, '[^A-Za-z0-9._-]', '_', 'g'), 1, 200) END AS id FROM pages")
def safe_ids(e) -> DataFrame:
    return e.pages.select("page_id", T.safe_id(F.when(F.col("page_id") % 5 != 0, F.col("url"))).alias("id"))


@query(
    "d05_d06_json_fallback",
    """SELECT message_id, coalesce(TRY_CAST(json_extract_string(CASE WHEN message_id % 7 = 0 THEN '{}' ELSE body END, '$.k') AS BIGINT), -1) AS k, CASE WHEN value > 20 THEN '{"k":1,"v":2}' ELSE '{"k":1}' END AS payload,
    CASE WHEN message_id % 3 = 0 THEN CAST(message_id % 9 AS VARCHAR) END AS fetch FROM messages""",
)
def json_fallback(e) -> DataFrame:
    body = F.when(F.col("message_id") % 7 == 0, "{not json").otherwise(F.col("body"))
    k = F.coalesce(F.from_json(body, "k long")["k"], F.lit(-1).cast("long"))
    state = F.concat(F.lit('timed out. Diagnostic: {"queues": {"fetch": '), (F.col("message_id") % 9).cast("string"), F.lit("}}"))
    message = F.when(F.col("message_id") % 3 == 0, state).when(F.col("message_id") % 3 == 1, "timed out. Diagnostic: {cut").otherwise("timed out")
    return e.messages.select("message_id", k.alias("k"), F.to_json(F.struct(F.lit(1).alias("k"), F.when(F.col("value") > 20, F.lit(2)).alias("v"))).alias("payload"), F.get_json_object(T.embedded_json(message), "$.queues.fetch").alias("fetch"))


@query(
    "d02_d07_d08_times",
    """SELECT id, CAST(epoch(done_at) - epoch(started_at) AS DOUBLE) AS seconds, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS shown, CAST(epoch(started_at) AS BIGINT) AS naive, CAST(epoch(started_at) AS BIGINT) AS zulu, CAST(epoch(started_at) AS BIGINT) - 7200 AS eastern FROM tasks WHERE done_at IS NOT NULL""",
)
def times(e) -> DataFrame:
    """Seconds between two times; a time as it is shown; texts without a zone count as UTC, and Z and offsets are understood."""
    text = F.date_format("started_at", "yyyy-MM-dd'T'HH:mm:ss")
    at = lambda zone: F.unix_seconds(lists.utc_time(F.concat(text, F.lit(zone))))
    seconds = (F.unix_micros(F.col("done_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6
    shown = F.date_format(F.timestamp_seconds(F.unix_seconds(F.col("started_at").cast("timestamp"))), "yyyy-MM-dd HH:mm:ss")
    return e.tasks.where("done_at is not null").select("id", seconds.alias("seconds"), shown.alias("shown"), at("").alias("naive"), at("Z").alias("zulu"), at("+02:00").alias("eastern"))


# --- text. The script's rules don't touch Latin texts, so a page stands between two texts of it whose canonical forms are written out here.

_ODD = points("F73 / F75 / F77 / F79 / F81 / F43 / F4D / F52 / F57 / F5C / F69 / F76 / F78 / F93 / F9D / FA2 / FA7 / FAC / FB9 / F48 / F98 / F00 / F45 F39 / F46 F39 / F47 F39")
_VOWELS = "F71 F72 / F71 F74 / FB2 F71 F80 / FB3 F71 F80 / F71 F80"
_TAIL = "F47 FB7 / F97 FB7 / F68 F7C F7E / F59 / F5A / F5B"
_APART = points(f"{_VOWELS} / F42 FB7 / F4C FB7 / F51 FB7 / F56 FB7 / F5B FB7 / F40 FB5 / FB2 F80 / FB3 F80 / F92 FB7 / F9C FB7 / FA1 FB7 / FA6 FB7 / FAB FB7 / F90 FB5 / {_TAIL}")
_WHOLE = points(f"{_VOWELS} / F43 / F4D / F52 / F57 / F5C / F69 / F76 / F78 / F93 / F9D / FA2 / FA7 / FAC / FB9 / {_TAIL}")


@query("t01_unified_spelling", f"SELECT page_id, '{_APART}' || page_text || '{_APART}' AS parts, '{_WHOLE}' || page_text AS whole FROM page_output")
def unified(e) -> DataFrame:
    text = F.concat(F.lit(_ODD), "page_text", F.lit(_ODD))
    return e.page_output.select("page_id", T.unify(text).alias("parts"), T.unify(F.concat(F.lit(_APART), "page_text"), composed=True).alias("whole"))


_ALIKE = points("F40 F0C / F0E / F38 / F40 F7A F7A / F40 F7C F7C / F07 / F40 F71 F90 / F40 FB0 F0B / F40 FB0 F90 / F40 F71 F72")
_FOLDED = points("F40 F0B / F0D F0D / F27 / F40 F7B / F40 F7D / FD3 F0D FD2 F0D / F40 FB0 F90 / F40 F71 F0B / F40 FB0 F90 / F40 F71 F72")
_K, _KA, _I, _A, _SUB = (chr(p) for p in (0xF40, 0xF66, 0xF72, 0xF71, 0xF90))


@query("t02_graphical_fold", f"SELECT page_id, '{_FOLDED}' || page_text || '{_FOLDED}{_K}{_A}' AS t FROM page_output")
def folded(e) -> DataFrame:
    return e.page_output.select("page_id", T.graphical_fold(F.concat(F.lit(_ALIKE), "page_text", F.lit(_ALIKE + _K + chr(0xFB0)))).alias("t"))


@query("t04_start_repair", f"SELECT page_id, CASE page_id % 6 WHEN 0 THEN '{_K}{_I}' || page_text WHEN 1 THEN '{_K}' || page_text WHEN 2 THEN '{_I}{_A}' || page_text WHEN 3 THEN '{_I}{_SUB}' || page_text WHEN 4 THEN '{_I}' ELSE page_text END AS t FROM page_output")
def repaired(e) -> DataFrame:
    start = F.element_at(F.array(*[F.lit(s) for s in (_I + _K, _SUB + _K, _I + _A, _I + _SUB, _I, "")]), (F.col("page_id") % 6 + 1).cast("int"))
    return e.page_output.select("page_id", T.repair_start(F.concat(start, F.when(F.col("page_id") % 6 == 4, "").otherwise(F.col("page_text")))).alias("t"))


_MESSY = points("F90 F66 F7C F90 F71 / F6A F40 / F6A F90 / F40 F35 F39 / F40 F7F F7E F18 / F0B F72 F71 / F22 F3E F37 / F0E")
_CLEAN = points("F66 F90 F71 F7C / F62 F40 / F6A F90 / F40 F39 F35 / F40 F18 F7E F7F / F0B F72 F71 / F22 F37 F3E / F0D F0D")


@query("t03_t05_canonical_text", f"SELECT page_id, CASE WHEN page_id % 7 = 0 THEN '' ELSE '{_CLEAN}' || page_text END AS t FROM page_output")
def canonical(e) -> DataFrame:
    return e.page_output.select("page_id", T.canonical(F.when(F.col("page_id") % 7 != 0, F.concat(F.lit(_MESSY), "page_text"))).alias("t"))


_TSHEG, _SHAD = chr(0xF0B), chr(0xF0D)
_TOK = rf"list_filter(string_split_regex(translate(page_text, ',.', '{_TSHEG}{_SHAD}'), '[{_TSHEG}{_SHAD}\s]+'), lambda x: x <> '')"


@query("t06_t07_repetition_score", f"WITH t AS (SELECT page_id, {_TOK} AS w FROM page_output), g AS (SELECT page_id, len(w) AS n, CASE WHEN len(w) < 20 THEN [] ELSE list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i : i + 19], chr(31))) END AS runs FROM t) SELECT page_id, n, CASE WHEN n < 20 THEN 0.0 ELSE round(1 - len(list_distinct(runs)) / len(runs), 6) END AS score FROM g")
def repetition(e) -> DataFrame:
    return e.page_output.select("page_id", T.repetition(F.translate("page_text", ",.", _TSHEG + _SHAD)).alias("r")).select("page_id", "r.n", F.round("r.score", 6).alias("score"))


@query("t08_edit_distance", "WITH t AS (SELECT item_id, regexp_replace(text, '[^ -~]', '', 'g') AS text FROM benchmark) SELECT a.item_id, levenshtein(a.text, b.text) AS d FROM t a JOIN t b ON b.item_id = a.item_id + 1")
def edit_distance(e) -> DataFrame:
    t = e.benchmark.select("item_id", F.regexp_replace("text", "[^ -~]", "").alias("text"))  # ASCII alone: engines differ in what a character is
    nxt = t.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other"))
    return t.join(nxt, "item_id").select("item_id", F.levenshtein("text", "other").cast("long").alias("d"))


_WORD = "unnest(string_split(text, ' ')) AS a, generate_subscripts(string_split(text, ' '), 1) AS n FROM benchmark"


@query("t09_differing_chars", f"WITH w AS (SELECT item_id, {_WORD}) SELECT item_id, n, CAST(CASE WHEN n % 3 = 0 THEN length(a) WHEN n % 3 = 1 THEN 2 ELSE 0 END AS BIGINT) AS d FROM w")
def differing(e) -> DataFrame:
    """Characters that differ between a word and what was read for it: another word altogether, two signs more, the word itself."""
    w = e.benchmark.select("item_id", F.posexplode(F.split("text", " ")).alias("n", "a")).withColumn("n", F.col("n") + 1)
    read = F.when(F.col("n") % 3 == 0, F.regexp_replace("a", "(?s).", "#")).when(F.col("n") % 3 == 1, F.concat("a", F.lit("##"))).otherwise(F.col("a"))
    return w.select("item_id", F.col("n").cast("long").alias("n"), T.differing_chars("a", read).alias("d"))


@query(
    "a24_j15_accuracy",
    r"""WITH t AS (SELECT item_id, string_split(regexp_replace(text, '[^ -~]', '', 'g'), ' ') AS a FROM benchmark), w AS (SELECT item_id, unnest(a) AS a, generate_subscripts(a, 1) AS n FROM t), r AS (SELECT item_id, a, CASE WHEN n % 4 = 0 THEN replace(a, 'a', 'oo') ELSE a END AS b FROM w)
    SELECT item_id, CAST(sum(length(a)) AS BIGINT) AS chars, CAST(sum(levenshtein(a, b)) AS BIGINT) AS differing, count(*) FILTER (a <> b) AS lines, round(1 - sum(levenshtein(a, b)) / nullif(sum(length(a)), 0), 6) AS accuracy FROM r GROUP BY item_id""",
)
def accuracy(e) -> DataFrame:
    """Reference and current lines (here words) by position; the share of characters that are right. Different numbers of lines are an error."""
    golden = e.benchmark.select("item_id", F.split(F.regexp_replace("text", "[^ -~]", ""), " ").alias("a"))
    current = golden.select("item_id", F.transform("a", lambda w, k: F.when(k % 4 == 3, F.replace(w, F.lit("a"), F.lit("oo"))).otherwise(w)).alias("b"))
    return line_accuracy(golden, current, "item_id")


@query("t10_syllables", rf"""WITH t AS (SELECT item_id, CASE WHEN item_id % 3 = 0 THEN '{_TSHEG} ' ELSE '' END AS lead, translate(regexp_replace(text, '^[ ,.]+', ''), ',.', '{_SHAD}{_TSHEG}') AS t FROM benchmark), m AS (SELECT item_id, CASE WHEN lead <> '' THEN substr(t, 1, 1) || lead || substr(t, 2) ELSE t END AS t FROM t),
    p AS (SELECT item_id, regexp_extract_all(t, '[^ {_SHAD}{_TSHEG}]+[ {_SHAD}{_TSHEG}]*') AS p FROM m) SELECT item_id, len(p) AS n, p[1] AS first, list_aggregate(list_transform(p, lambda x: length(x)), 'max') AS longest FROM p""")
def syllable_pieces(e) -> DataFrame:
    t = F.translate(F.regexp_replace("text", "^[ ,.]+", ""), ",.", _SHAD + _TSHEG)
    p = T.syllables(F.concat(F.when(F.col("item_id") % 3 == 0, f"{_TSHEG} ").otherwise(""), t))
    return e.benchmark.select("item_id", p.alias("p")).select("item_id", F.size("p").cast("long").alias("n"), F.col("p")[0].alias("first"), F.array_max(F.transform("p", lambda x: F.length(x))).cast("long").alias("longest"))


@query("t11_t12_script_lines", "SELECT page_id, len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[ༀ-࿿]'))) AS n, t FROM (SELECT page_id, page_text || CASE WHEN page_id % 2 = 0 THEN chr(10) || 'བོད' ELSE chr(10) END AS t FROM page_output)")
def script_lines(e) -> DataFrame:
    """The text of a page from its lines, and how many of these are in the script."""
    lines = F.concat(F.split("page_text", "\n"), F.array(F.when(F.col("page_id") % 2 == 0, "བོད").otherwise("")))
    t = F.array_join(lines, "\n")
    return e.page_output.select("page_id", T.script_lines(t).cast("long").alias("n"), t.alias("t"))


@query("t13_lines_of_generations", "SELECT page_id, CAST(u.n - 1 AS BIGINT) AS line, u.t AS text FROM (SELECT page_id, unnest(string_split(page_text, chr(10))) AS t, generate_subscripts(string_split(page_text, chr(10)), 1) AS n FROM page_output) u")
def generations(e) -> DataFrame:
    lines = F.when(F.col("page_id") % 3 == 0, F.split("page_text", "\n"))
    newer = e.page_output.select("page_id", lines.alias("line_texts"), F.when(F.col("page_id") % 3 == 1, F.col("page_text")).alias("page_text"), F.when(F.col("page_id") % 3 == 2, F.split("page_text", "\n")).alias("texts"))
    return newer.select("page_id", F.posexplode(F.coalesce("line_texts", F.split("page_text", "\n"), "texts")).alias("line", "text")).select("page_id", F.col("line").cast("long").alias("line"), "text")

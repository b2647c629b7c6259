"""SQL of the reading steps that look at what a match says, and with them of the whole script."""

from __future__ import annotations

from inkmill.operators import gloss as G
from inkmill.plans.catalog import ABBREVIATED, CAPS, CHAPTERED, LINES, MARKED, READINGS, SP, SQL, SQUEEZE, STRIP, TOLD, WORDS, query, small_sql, texts, texts_sql
from inkmill.plans.records import CHAPTER_LINE, MARKETING, MARKS, ROMAN_STEP, SECTION_NUMBERS, SIGNS, SPOKEN, arrows_step, chain

A, AW = r"\p{L}\p{N}", r"\p{L}\p{N}_"
_LINK = r"(?i)\b(?:https?://|www\.)\S+|\S+@\S+\.\S+"


def _between(pattern: str, x: str, fn, i: str) -> str:
    """``fn`` of what lies between the matches of a pattern."""
    return f"array_to_string(list_transform(range(1, len(string_split_regex({x}, '{pattern}')) + 1), lambda {i}: {fn(f'(string_split_regex({x}, {chr(39)}{pattern}{chr(39)}))[{i}]')} || coalesce(regexp_extract_all({x}, '{pattern}')[{i}], '')), '')"


# --- numbers ---------------------------------------------------------------------------------------------------------

_KEPT = r"\d{1,2}:\d{2}|\d{1,2}/\d{1,2}(?:/\d{2,4})?|\d{1,3}(?:\.\d{3})+(?:,\d+)?|\d+[.,]\d+|\d+(?:[.,]\d+)?\s*%"
_N = "coalesce(TRY_CAST(t AS BIGINT), 0)"
_LOW, _HIGH = small_sql(f"({_N} % 1000)"), small_sql(f"({_N} // 1000 % 1000)")
_READ = f"CASE WHEN {_N} < 1000 THEN {_LOW} ELSE {_HIGH} || ' nghìn' || (CASE WHEN {_N} % 1000 = 0 THEN '' WHEN {_N} % 1000 < 100 THEN ' không lẻ ' || {_LOW} ELSE ' ' || {_LOW} END) END"
_SPELLED = lambda x: f"array_to_string(list_transform(regexp_extract_all({x}, '[{AW}]+|[^{AW}]+'), lambda t: CASE WHEN regexp_full_match(t, '0|[1-9][0-9]{{0,5}}') THEN {_READ} ELSE t END), '')"
NUMBERS = _between(_LINK, "text", lambda part: _between(_KEPT, part, _SPELLED, "j"), "i")
COUNTED = ["Có 3 người, 007, 1.5, 10:30, 5%, 1,250 và 1234567", "http://a/5 6 me7@x.y8 9", "12/09 12/09/2026 3 4_5 x6 7x 8", "0 00 100000 999999 1.234.567,8 9 %", "12:3045 5%x7"]


@query(f"SELECT doc_id, {NUMBERS} AS text FROM {texts_sql(COUNTED)}")
def spelled_numbers(spark, sf_dir):
    return texts(spark, sf_dir, COUNTED).select("doc_id", G.standalone_numbers("text").alias("text"))


# --- colons ----------------------------------------------------------------------------------------------------------

_TAIL, _HEAD, _BODY = "a[1].t", "regexp_replace(a[1].t, '[ \\t]+$', '')", "regexp_replace(b[1].s, '^[ \\t]+', '')"
_FIRST = f"CASE WHEN regexp_matches({_BODY}, '^\\p{{Ll}}') THEN upper({_BODY}[1]) ELSE '' END"
_REST = f"CASE WHEN regexp_matches({_BODY}, '^\\p{{Ll}}') THEN {_BODY}[2:] ELSE {_BODY} END"
_GLUE = f"CASE WHEN {_HEAD} = '' THEN '' ELSE (CASE WHEN regexp_matches({_HEAD}, '[.!?;,]$') THEN '' ELSE '.' END) || (CASE WHEN {_BODY} = '' AND b[1].e OR {_BODY}[1] = chr(10) THEN '' ELSE ' ' END) END"
_SAID = f"left(a[1].s, length(a[1].s) - length({_TAIL}) + length({_HEAD})) || ({_GLUE}) || ({_FIRST}) || ({_REST})"
_DIGITS = f"regexp_matches({_TAIL}, '[0-9]$') AND regexp_matches(b[1].s, '^[0-9]')"
_ENDED = lambda x: (
    f"(list_reduce(list_transform(range(1, len(string_split({x}, ':')) + 1), lambda k: [{{'s': string_split({x}, ':')[k], 't': string_split({x}, ':')[k], 'e': k = len(string_split({x}, ':'))}}]), "
    f"lambda a, b: CASE WHEN {_DIGITS} THEN [{{'s': a[1].s || ':' || b[1].s, 't': b[1].s, 'e': false}}] ELSE [{{'s': {_SAID}, 't': {_REST}, 'e': false}}] END))[1].s"
)
COLONS = _between(_LINK, "text", _ENDED, "i")
ENDED = ["Nhớ một nguyên tắc: phục vụ.", "10:30 https://a:b x:y", "a:\nb: \nc :d", ": x", "a::b:c", "một. : hai, : ba", "A: Bê 3: 4 5:6", "x:"]


@query(f"SELECT doc_id, {COLONS} AS text FROM {texts_sql(ENDED)}")
def ended_colons(spark, sf_dir):
    return texts(spark, sf_dir, ENDED).select("doc_id", G.colons("text").alias("text"))


# --- slashes ---------------------------------------------------------------------------------------------------------

_PER = "('năm', 'tháng', 'quý', 'tuần', 'ngày', 'giờ', 'phút', 'giây', 'người', 'lần', 'lượt', 'khách', 'đơn', 'ca', 'suất', 'buổi', 'kỳ', 'suốt', 'đêm')"
_SUMS = "('triệu', 'tỷ', 'tỉ', 'nghìn', 'ngàn', 'trăm', 'đồng', 'đ', 'k', 'usd/vnd', 'đô')"
_EITHER = (
    "('có/không', 'đúng/sai', 'nam/nữ', 'online/offline', 'offline/online', 'được/không', 'thắng/thua', 'mua/bán', 'lời/lỗ', 'lãi/lỗ', 'tăng/giảm', 'trước/sau', 'trong/ngoài', 'yes/no', 'on/off')"
)
_RATE = f"[0-9][0-9.,]*%?(?:[ \\t]*[-–][ \\t]*[0-9][0-9.,]*%?)?[ \\t]+[{AW}]+$"
_LAST = "d[len(d)]"
_RATES = f"CASE WHEN lower(regexp_extract(e[1].s, '^[{AW}]+')) IN {_PER} AND regexp_matches({_LAST}.s, '{_RATE}') THEN list_append(d[1:len(d) - 1], {{'m': {_LAST}.m, 's': {_LAST}.s || ' một ' || e[1].s, 'u': false}}) ELSE list_concat(d, e) END"
_L, _R = f"regexp_extract({_LAST}.s, '[{A}]+%?$')", f"regexp_extract(e[1].s, '^[{A}]+')"
_BOTH = f"lower({_L} || '/' || {_R})"
_SEP = (
    f"CASE WHEN {_BOTH} IN ('24/7', 'và/hoặc') THEN ' ' WHEN {_BOTH} IN {_EITHER} THEN ' hoặc ' WHEN regexp_full_match({_BOTH}, '[0-9.,/]*') THEN NULL "
    f"WHEN lower({_R}) IN {_PER} AND (lower({_L}) IN {_SUMS} OR regexp_full_match({_L}, '[0-9][0-9.,]*[{A}]{{0,3}}%?')) THEN ' một ' WHEN regexp_full_match({_L}, '\\p{{Lu}}') AND regexp_full_match({_R}, '\\p{{Lu}}') THEN ' hoặc ' ELSE ', ' END"
)
_USED = f"e[1].s IN ({_R}, {_R} || '%')"
_PASS = (
    f"CASE WHEN {_LAST}.u OR {_L} = '' OR {_R} = '' THEN list_append(d, {{'m': e[1].m, 's': e[1].s, 'u': false}}) WHEN ({_SEP}) IS NULL THEN list_append(d, {{'m': e[1].m, 's': e[1].s, 'u': {_USED}}}) "
    f"ELSE list_append(d[1:len(d) - 1], {{'m': {_LAST}.m, 's': {_LAST}.s || ({_SEP}) || (CASE WHEN {_BOTH} = 'và/hoặc' THEN lower({_R}) ELSE {_R} END) || e[1].s[length({_R}) + 1:], 'u': {_USED}}}) END"
)


def _slashed(x: str) -> str:
    cut = "[ \\t]*/[ \\t]*"
    items = f"list_transform(range(1, len(string_split_regex({x}, '{cut}')) + 1), lambda k: [{{'m': coalesce((list_concat([''], regexp_extract_all({x}, '{cut}')))[k], ''), 's': string_split_regex({x}, '{cut}')[k], 'u': false}}])"
    out = f"list_reduce({items}, lambda d, e: {_RATES})"
    for _ in range(4):
        out = f"list_reduce(list_transform({out}, lambda y: [{{'m': y.m, 's': y.s, 'u': false}}]), lambda d, e: {_PASS})"
    return f"array_to_string(list_transform({out}, lambda y: y.m || y.s), '')"


SLASHES = f"CASE WHEN NOT contains(text, '/') THEN text ELSE {_between(_LINK, 'text', _slashed, 'i')} END"
SLASHED = [
    "Đọc sách/tạp chí", "Chọn có/không, A/B", "300 triệu/năm, 3 ngày/tuần, 1%/tháng", "12/09/2026 24/7 và/hoặc Và/Hoặc http://a/b", "a/1/2/b 1/2/x/y a/b/c/d/e", "5kg/người 200 / ngày x /y z/ w a//b /c d/",
    "3-4 giờ/ngày/tuần, 2 _ab/năm", "5%/7% 10%/năm a%/b% me@x.y/z",
]


@query(f"SELECT doc_id, {SLASHES} AS text FROM {texts_sql(SLASHED)}")
def read_slashes(spark, sf_dir):
    return texts(spark, sf_dir, SLASHED).select("doc_id", G.slashes("text").alias("text"))


# --- the whole script ------------------------------------------------------------------------------------------------

_PAGES = f"array_to_string(list_filter({LINES('text')}, lambda s: NOT regexp_matches(s, '(?i)^[{SP}]*(?:trang[{SP}]+|page[{SP}]+|tr\\.?)?[-–—]?[{SP}]*[0-9]{{1,4}}[{SP}]*[-–—]?[{SP}]*$')), chr(10))"
_NUMBERED = f"^[{SP}]*([0-9]{{1,2}})[.)][{SP}]+(\\p{{L}}[^\\n]*)$"
_BULLET = f"^[{SP}]*(?:[-–—•●▪◦○∙·+*]|[a-zA-ZđĐ]\\))[{SP}]+([^{SP}][^\\n]*)$"
_NTH = f"(CASE regexp_extract(s, '{_NUMBERED}', 1)::INT WHEN 1 THEN 'nhất' WHEN 4 THEN 'tư' ELSE {small_sql(f'''(regexp_extract(s, '{_NUMBERED}', 1)::BIGINT)''')} END)"
_LISTS = (
    f"array_to_string(list_transform({LINES('text')}, lambda s: CASE WHEN regexp_matches(s, '{_NUMBERED}') THEN CASE WHEN regexp_matches(regexp_extract(s, '{_NUMBERED}', 2), '(?i)^(?:thứ[{SP}]|đầu tiên|trước hết|cuối cùng|sau cùng)') THEN regexp_extract(s, '{_NUMBERED}', 2) "
    f"ELSE 'Thứ ' || {_NTH} || ', ' || regexp_extract(s, '{_NUMBERED}', 2) END WHEN regexp_matches(s, '{_BULLET}') THEN regexp_extract(s, '{_BULLET}', 1) ELSE s END), chr(10))"
)
_AND = "text"
for _ in range(3):
    _AND = f"regexp_replace({_AND}, '([{A}])[ \\t]*&[ \\t]*([{A}])', '\\1 và \\2', 'g')"
_TO = "text"
for _ in range(2):
    _TO = f"regexp_replace({_TO}, '(^|[^0-9.,/:-])([0-9]{{1,2}})[ \\t]*[-–][ \\t]*([0-9]{{1,2}})($|[^0-9/.,:-]|[.,](?:\\s|$))', '\\1\\2 đến \\3\\4', 'g')"
_LONE = "text"
for _ in range(2):
    _LONE = f"regexp_replace({_LONE}, '(^|[^{AW}&])P([^{AW}&]|$)', '\\1Pê\\2', 'g')"
SQL["reading_script"] = chain(
    texts_sql([*READINGS, *TOLD]), MARKS, _PAGES, SECTION_NUMBERS, _LISTS, ABBREVIATED, SPOKEN, _AND, arrows_step("{prev}"), SLASHES, _TO, COLONS, ROMAN_STEP, SIGNS, MARKETING("text"), _LONE, NUMBERS, STRIP(SQUEEZE)
)


# --- markdown --------------------------------------------------------------------------------------------------------

_ITEM = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '^\\s*>\\s?', ''), '^\\s*[*+-]\\s+', ''), '^\\s*[0-9]+[.)]\\s+', ''), '^\\s*[*_]{3,}\\s*$', '')"
_HASH = f"^(#{{1,6}})[{SP}]+(.*[^{SP}])[{SP}]*#*[{SP}]*$"
_MARK = f"repeat('=', least(length(regexp_extract(r, '{_HASH}', 1)) + 1, 4)::INT)"
#: Underlines make a heading of the line before them, if that says something, each once more; one without such a line
#: is a line itself. A line and the underlines after it are an island.
SQL["markdown_text"] = (
    f"WITH l AS (SELECT doc_id, i, s, regexp_replace(s, '[{SP}]+$', '') AS r, CASE WHEN regexp_matches(s, '^[{SP}]*```') THEN 1 ELSE 0 END AS f FROM (SELECT doc_id, unnest({LINES('text')}) AS s, generate_subscripts({LINES('text')}, 1) AS i FROM "
    f"(SELECT doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM {texts_sql(MARKED)}))), "
    "p AS (SELECT *, f = 1 OR sum(f) OVER (PARTITION BY doc_id ORDER BY i) % 2 = 1 AS code FROM l), "
    f"o AS (SELECT *, NOT code AND NOT regexp_matches(r, '{_HASH}') AND regexp_matches(r, '^(?:={{3,}}|-{{3,}}|~{{3,}}|\\*{{3,}}|_{{3,}})\\s*$') AS under, "
    f"CASE WHEN code THEN '' WHEN regexp_matches(r, '{_HASH}') THEN {_MARK} || ' ' || {STRIP(f'''regexp_extract(r, '{_HASH}', 2)''')} || ' ' || {_MARK} ELSE {_ITEM} END AS out FROM p), "
    "g AS (SELECT *, sum(CASE WHEN under THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS island FROM o), "
    f"u AS (SELECT *, under AND coalesce(bool_or({STRIP('out')} <> '') OVER (PARTITION BY doc_id, island ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS makes FROM g), "
    "h AS (SELECT *, count(*) FILTER (makes) OVER (PARTITION BY doc_id, island) AS n FROM u) "
    f"SELECT doc_id, coalesce(string_agg(CASE WHEN n > 0 AND {STRIP('out')} <> '' THEN repeat('== ', n) || {STRIP('out')} || repeat(' ==', n) ELSE out END, chr(10) ORDER BY i) FILTER (NOT makes), '') AS text FROM h GROUP BY doc_id"
)


# --- chapters --------------------------------------------------------------------------------------------------------

_NO_CHAPTER = (
    "mục lục|mụclục|nội dung|table of contents|contents|toc|danh mục|liên kết ngoài|liên kết|tham khảo|nguồn|ghi chú|ghi chú bản dịch|chú thích|chú thích sách|bản quyền|giấy phép|license|licence|"
    "tác giả|soạn giả|người dịch|ban dịch|bản dịch|translator|translator[s]?|xem thêm|see also|liên quan|bibliography|thư mục|phụ lục|phụlục|appendix|phần đầu|phần cuối|lời giới thiệu|lời nói đầu|lời ngỏ|lời cảm ơn"
)
_CLEAN = lambda x: STRIP(f"regexp_replace({x}, '^[^\\p{{L}}]+', '')")
_FRONT = lambda x: f"(length({_CLEAN(x)}) BETWEEN 1 AND 60 AND regexp_matches({_CLEAN(x)}, '(?i)^(?:{_NO_CHAPTER})') AND regexp_replace(regexp_replace({_CLEAN(x)}, '(?i)^(?:{_NO_CHAPTER})', ''), '[ .:\\-–—]', '', 'g') = '')"
_WIKI = lambda k: f"^[{SP}]*={{{k}}}[{SP}]*([^=].*?[^{SP}]|[^={SP}])[{SP}]*={{{k}}}[{SP}]*$"
_HEADING = (
    "CASE " + " ".join(f"WHEN regexp_matches(s, '{_WIKI(k)}') THEN {STRIP(f'''regexp_extract(s, '{_WIKI(k)}', 1)''')}" for k in range(2, 7)) + f" WHEN regexp_matches(s, '^#{{1,6}}[{SP}]+.*[^{SP}][{SP}]*#*[{SP}]*$') "
    f"THEN {STRIP(f'''regexp_extract(s, '^#{{1,6}}[{SP}]+(.*[^{SP}])[{SP}]*#*[{SP}]*$', 1)''')} END"
)
_RULED = f"{STRIP('s')} <> '' AND length(s) <= 90 AND regexp_matches(regexp_replace(next, '[{SP}]+$', ''), '^(?:={{3,}}|-{{3,}}|~{{3,}}|\\*{{3,}}|_{{3,}}|#{{3,}})$')"
_OPENS = f"{CHAPTER_LINE} OR (w < 4000 AND next IS NOT NULL AND regexp_matches(s, '(?i)^[{SP}]*(?:[0-9]{{1,3}}|[ivxlcdm]{{1,7}})[.):]?[{SP}]*$')) OR ({CAPS})"
#: Sections at marks, the opening before the first of them, and short ones folded into the next long one.
SECTIONS = (
    "t AS (SELECT doc_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text FROM {source} WHERE text IS NOT NULL), "
    f"l AS (SELECT *, lead(s) OVER (PARTITION BY doc_id ORDER BY i) AS next FROM (SELECT doc_id, {WORDS('text')} AS w, unnest({LINES('text')}) AS s, generate_subscripts({LINES('text')}, 1) AS i FROM t)), "
    f"h AS (SELECT *, {_HEADING} AS head FROM l), "
    f"m AS (SELECT doc_id, i, coalesce(head, {STRIP('s')}) AS title, CASE WHEN head IS NOT NULL THEN {_FRONT('head')} ELSE {_FRONT('s')} END AS front FROM h WHERE head IS NOT NULL OR ({_RULED}) OR {_FRONT('s')} OR {_OPENS}), "
    "e AS (SELECT *, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i), 1000000000) AS stop FROM m), "
    "f AS (SELECT doc_id, min(i) AS at FROM m WHERE NOT front GROUP BY doc_id), "
    f"c AS (SELECT e.doc_id, e.i, e.title, {STRIP('''coalesce(string_agg(l.s, chr(10) ORDER BY l.i), '')''')} AS text FROM e LEFT JOIN l ON l.doc_id = e.doc_id AND l.i > e.i AND l.i < e.stop WHERE NOT e.front GROUP BY e.doc_id, e.i, e.title "
    f"UNION ALL SELECT * FROM (SELECT l.doc_id, 0, 'Phần mở đầu', {STRIP('string_agg(s, chr(10) ORDER BY i)')} AS o FROM l JOIN f ON l.doc_id = f.doc_id AND l.i < f.at GROUP BY l.doc_id) WHERE {WORDS('o')} >= 8 "
    f"UNION ALL SELECT doc_id, 0, 'Nội dung', text FROM t WHERE {STRIP('text')} <> '' AND doc_id NOT IN (SELECT doc_id FROM m)), "
    f"k AS (SELECT *, {WORDS('text')} AS n FROM c WHERE {STRIP('text')} <> ''), "
    "g AS (SELECT *, coalesce(sum(CASE WHEN n >= 40 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(CASE WHEN n >= 40 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS longs FROM k), "
    f"j AS (SELECT doc_id, least(before, greatest(longs - 1, 0)) AS g, count(*) AS parts, arg_max(title, n * 1000000 - i) AS title, CASE WHEN count(*) = 1 THEN min(text) ELSE string_agg({STRIP('text')}, chr(10) || chr(10) ORDER BY i) END AS text FROM g GROUP BY ALL)"
)
SQL["detected_chapters"] = (
    "WITH " + SECTIONS.replace("{source}", texts_sql(CHAPTERED)) + f" SELECT doc_id, index, 'chuong-' || lpad(index::VARCHAR, greatest(2, length(index::VARCHAR))::INT, '0') AS slug, title, 1::INT AS level, {WORDS('text')}::INT AS word_count, sha256(text) AS sha256 "
    "FROM (SELECT *, (row_number() OVER (PARTITION BY doc_id ORDER BY g))::INT AS index FROM j)"
)

_TRIMMED = lambda x: f"regexp_replace({x}, '[ ,;:\\-—…]+$', '')"
_LINE = _TRIMMED(f"regexp_replace(string_split({STRIP('text')}, chr(10))[1], '[{SP}]+$', '')")
_CLIPPED = f"CASE WHEN length({_LINE}) <= 48 THEN {_LINE} ELSE {_TRIMMED(f'''coalesce(nullif(regexp_extract({_LINE}, '^(.{{1,47}}) ', 1), ''), left({_LINE}, 48))''')} END"
#: Lines folded into the next of 40 words; what has over 400 split at paragraphs and windows; what has under 150 merged.
SQL["structured_chapters"] = (
    f"WITH RECURSIVE l AS (SELECT doc_id, i, s, {WORDS('s')} AS n FROM (SELECT doc_id, unnest({LINES('text')}) AS s, generate_subscripts({LINES('text')}, 1) AS i FROM documents)), "
    "b AS (SELECT *, coalesce(sum(CASE WHEN n >= 40 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(CASE WHEN n >= 40 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS longs FROM l), "
    f"j AS (SELECT doc_id, least(before, greatest(longs - 1, 0)) AS g, CASE WHEN count(*) = 1 THEN min(s) ELSE coalesce(string_agg({STRIP('s')}, chr(10) || chr(10) ORDER BY i) FILTER ({STRIP('s')} <> ''), '') END AS text, sum(n) AS w FROM b GROUP BY ALL), "
    f"q AS (SELECT doc_id, g, i, {STRIP('p')} AS p, {WORDS('p')} AS n FROM (SELECT doc_id, g, unnest(string_split_regex(text, '\\n\\s*\\n')) AS p, generate_subscripts(string_split_regex(text, '\\n\\s*\\n'), 1) AS i FROM j WHERE w > 400) WHERE {STRIP('p')} <> ''), "
    "o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS r, coalesce(n > 400 OR lag(n) OVER (PARTITION BY doc_id, g ORDER BY i) > 400, true) AS starts FROM q), "
    # packing within runs of paragraphs that are not too long
    "f(doc_id, g, r, pos, size) AS (SELECT doc_id, g, r, r, n FROM o WHERE starts AND n <= 400 UNION ALL SELECT o.doc_id, o.g, o.r, CASE WHEN f.size + o.n > 400 AND f.size >= 150 THEN o.r ELSE f.pos END, CASE WHEN f.size + o.n > 400 AND f.size >= 150 THEN o.n ELSE f.size + o.n END "
    "FROM f JOIN o ON o.doc_id = f.doc_id AND o.g = f.g AND o.r = f.r + 1 AND NOT o.starts), "
    "c AS (SELECT f.doc_id, f.g, f.pos, 0 AS k, string_agg(o.p, chr(10) || chr(10) ORDER BY o.r) AS text FROM f JOIN o USING (doc_id, g, r) GROUP BY f.doc_id, f.g, f.pos "
    "UNION ALL SELECT doc_id, g, r, k, array_to_string(ws[k * 400 + 1 : k * 400 + 400], ' ') FROM (SELECT doc_id, g, r, ws, unnest(range(0, (len(ws) + 399) // 400)) AS k FROM "
    f"(SELECT doc_id, g, r, list_filter(regexp_split_to_array(p, '[{SP}]+'), lambda x: x <> '') AS ws FROM o WHERE n > 400))), "
    "m AS (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS chunks FROM c), "
    "p AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY g, pos, k) AS part FROM m WHERE chunks > 1), "
    f"t AS (SELECT doc_id, g, pos, k, 'Phần ' || part || (CASE WHEN lower({_CLIPPED}) IN ('', 'văn') THEN '' ELSE ' — ' || ({_CLIPPED}) END) AS title, text FROM p UNION ALL SELECT doc_id, g, 0, 0, 'Văn', text FROM j WHERE (doc_id, g) NOT IN (SELECT (doc_id, g) FROM p)), "
    f"s AS (SELECT *, {WORDS('text')} AS w, row_number() OVER (PARTITION BY doc_id ORDER BY g, pos, k) AS i, CASE WHEN count(*) OVER (PARTITION BY doc_id) > 1 THEN 150 ELSE 0 END AS floor FROM t), "
    "z(doc_id, i, pos, w, title) AS (SELECT doc_id, i, 1, w, title FROM s WHERE i = 1 UNION ALL SELECT s.doc_id, s.i, CASE WHEN z.w < s.floor THEN z.pos ELSE z.pos + 1 END, CASE WHEN z.w < s.floor THEN z.w + s.w ELSE s.w END, "
    "CASE WHEN z.w < s.floor AND s.w <= z.w THEN z.title ELSE s.title END FROM z JOIN s ON s.doc_id = z.doc_id AND s.i = z.i + 1), "
    "y AS (SELECT doc_id, pos, max(w) AS w, arg_max(title, i) AS title FROM z GROUP BY doc_id, pos), "
    "e AS (SELECT y.doc_id, max(y.pos) AS stop, arg_max(y.w, y.pos) < max(s.floor) AND count(*) > 1 AS back FROM y JOIN s ON s.doc_id = y.doc_id AND s.i = 1 GROUP BY y.doc_id), "
    "x AS (SELECT y.doc_id, CASE WHEN back AND pos = stop THEN pos - 1 ELSE pos END AS index, y.w, y.title, pos FROM y JOIN e USING (doc_id)), "
    "u AS (SELECT doc_id, index, sum(w) AS n, arg_max(title, w * 1000000 - pos) AS title FROM x GROUP BY doc_id, index), "
    f"v AS (SELECT x.doc_id, x.index, CASE WHEN count(*) = 1 THEN min(s.text) ELSE coalesce(string_agg({STRIP('s.text')}, chr(10) || chr(10) ORDER BY s.i) FILTER ({STRIP('s.text')} <> ''), '') END AS text FROM x JOIN z ON z.doc_id = x.doc_id AND z.pos = x.pos JOIN s ON s.doc_id = z.doc_id AND s.i = z.i GROUP BY x.doc_id, x.index) "
    "SELECT doc_id, index::INT AS index, 'chuong-' || lpad(index::VARCHAR, greatest(2, length(index::VARCHAR))::INT, '0') AS slug, title, 1::INT AS level, n::INT AS word_count, sha256(text) AS sha256 FROM u JOIN v USING (doc_id, index)"
)

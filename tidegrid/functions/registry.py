"""SQL names for the scalar functions and the row-making functions."""

from pyspark.sql.functions import udtf

from tidegrid.functions.clock import EPOCH, NTP_OFFSET
from tidegrid.functions.headers import STANDARD_HEADERS
from tidegrid.functions.url import DEFAULT_PORTS, SCHEME_CLASSES, URL_PATTERN
from tidegrid.operators.returns import format_return
from tidegrid.sources.markup import NODE_FIELDS, _html_nodes, _xml_nodes

PARTS = "struct<scheme string, host string, port int, user string, pass string, path string, extra string>"
_PORT = "CASE lower({0}) " + " ".join(f"WHEN '{s}' THEN {p}" for s, p in DEFAULT_PORTS.items()) + " END"


def _text(value):
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _crack():
    groups = "\\u0001".join(f"${i}" for i in (1, 4, 5, 2, 3, 6, 7))
    part = "get(parts, {0})"
    port = f"coalesce(try_cast(nullif({part.format(2)}, '') AS int), {_PORT.format(part.format(0))})"
    fields = [f"lower({part.format(0)})", part.format(1), port, *[part.format(i) for i in (3, 4, 5, 6)]]
    return f"""(SELECT CASE WHEN size(parts) = 7 THEN CAST(struct({", ".join(fields)}) AS {PARTS}) END
        FROM (SELECT split(regexp_replace(url, {_text(URL_PATTERN)}, '{groups}'), '\\u0001') AS parts))"""


def _wildcard():
    escaped = r"regexp_replace(pattern, '([\\\\.\\[\\]{}()+^$|])', '\\\\$1')"
    for plain, mark in (("~*", "\\u0001"), ("~?", "\\u0002"), ("~~", "\\u0003")):
        escaped = f"replace({escaped}, '{plain}', '{mark}')"
    # A last ~ stands for itself, any other makes the character behind it plain.
    escaped = f"regexp_replace({escaped}, '~$', '\\u0003')"
    escaped = f"replace(replace(replace({escaped}, '*', '.*'), '?', '.'), '~', '')"
    for mark, plain in (("\\u0001", r"\\*"), ("\\u0002", r"\\?"), ("\\u0003", "~")):
        escaped = f"replace({escaped}, '{mark}', '{plain}')"
    return f"text rlike concat('(?isu)^', {escaped}, '\\\\z')"


def _header():
    """The wanted header in lower case, constant-style names turned into plain ones."""
    known = ", ".join(f"'{h.lower()}'" for h in STANDARD_HEADERS)
    plain = "replace(lower(regexp_replace(name, '(?i)^HTTP_QUERY_', '')), '_', '-')"
    return f"CASE WHEN {plain} IN ({known}) THEN {plain} ELSE lower(name) END"


def _functions():
    """Name and signature, result type, and body of each scalar function."""
    classes = ", ".join(f"'{c}'" for c in SCHEME_CLASSES)
    scheme = "lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
    login = "CASE WHEN p.user <> '' THEN concat(p.user, CASE WHEN p.pass <> '' THEN concat(':', p.pass) ELSE '' END, '@') ELSE '' END"
    port = f"CASE WHEN coalesce(p.port, 0) = 0 OR p.port <=> ({_PORT.format('p.scheme')}) THEN '' ELSE concat(':', p.port) END"
    bare = "p.host = '' AND lower(p.scheme) NOT IN ('http', 'https', 'ftp', 'file')"
    schema = "schema_of_variant(value)"
    return [
        ("crack_url(url string)", PARTS, _crack()),
        (
            f"create_url(p {PARTS})",
            "string",
            f"concat(p.scheme, CASE WHEN {bare} THEN ':' ELSE '://' END, {login}, p.host, {port}, p.path, p.extra)",
        ),
        (
            "url_scheme_class(url string)",
            "string",
            f"CASE WHEN {scheme} = '' THEN 'partial' WHEN {scheme} IN ({classes}) THEN {scheme} ELSE 'unknown' END",
        ),
        (
            "format_headers(headers map<string,string>)",
            "string",
            "CASE WHEN headers IS NULL THEN '' ELSE concat(array_join(transform(map_entries(headers), "
            "e -> concat(e.key, ': ', e.value, '\\r\\n')), ''), '\\r\\n') END",
        ),
        (
            "query_header(headers map<string,string>, name string)",
            "string",
            f"get(filter(map_entries(headers), e -> lower(e.key) = ({_header()})), 0).value",
        ),
        ("view_slice(text string, start int, n int)", "string", "substring(text, start + 1, n)"),
        ("view_len(text string)", "bigint", "length(text)"),
        (
            "view_drop(text string, n int)",
            "string",
            "CASE WHEN n >= 0 THEN substring(text, n + 1) ELSE substring(text, 1, greatest(length(text) + n, 0)) END",
        ),
        (
            "mktime(moment timestamp_ntz, zone string)",
            "bigint",
            f"timestampdiff(SECOND, timestamp_ntz'{EPOCH}', convert_timezone(zone, 'UTC', moment))",
        ),
        (
            "localtime_of(seconds bigint, zone string)",
            "timestamp_ntz",
            f"convert_timezone('UTC', zone, timestampadd(SECOND, seconds, timestamp_ntz'{EPOCH}'))",
        ),
        (
            "ntp_to_timestamp(seconds bigint, fraction bigint)",
            "timestamp",
            f"timestamp_micros((seconds - {NTP_OFFSET}) * 1000000 + cast(round(fraction / 4294967296.0D * 1000000) AS bigint))",
        ),
        (
            "timestamp_to_ntp(moment timestamp)",
            "struct<seconds bigint, fraction bigint>",
            f"named_struct('seconds', cast(floor(unix_micros(moment) / 1000000) AS bigint) + {NTP_OFFSET}, 'fraction', "
            "cast(round(pmod(unix_micros(moment), 1000000) / 1000000D * 4294967296D) AS bigint))",
        ),
        ("match_wildcard(text string, pattern string)", "boolean", _wildcard()),
        (
            "json_type(value variant)",
            "string",
            f"CASE WHEN value IS NULL THEN 'error' WHEN startswith({schema}, 'OBJECT') THEN 'object' "
            f"WHEN startswith({schema}, 'ARRAY') THEN 'array' WHEN {schema} = 'STRING' THEN 'string' "
            f"WHEN {schema} = 'BOOLEAN' THEN 'boolean' WHEN {schema} = 'VOID' THEN 'null' ELSE 'number' END",
        ),
        (
            "json_quote(text string)",
            "string",
            "substring(to_json(named_struct('v', text)), 6, length(to_json(named_struct('v', text))) - 6)",
        ),
        ("json_path_split(path string)", "array<string>", "split(substring(path, 2), '[.]')"),
        ("json_path_join(segments array<string>)", "string", "CASE WHEN size(segments) > 0 THEN concat('.', array_join(segments, '.')) ELSE '' END"),
    ]


_FIELDS = [name for name, _, _ in NODE_FIELDS]
_RETURNS = ", ".join(f"{name} {kind.simpleString()}" for name, kind, _ in NODE_FIELDS)


class _Nodes:
    """One row per node of a text."""

    read = None

    def eval(self, text: str):
        if text is not None:
            for node in type(self).read(text, {})[0]:
                yield tuple(node[f] for f in _FIELDS)


class _HtmlNodes(_Nodes):
    read = staticmethod(_html_nodes)


class _XmlNodes(_Nodes):
    read = staticmethod(_xml_nodes)


def register_functions(spark):
    """Make the functions known to SQL for this session; returns their names."""
    names = []
    for signature, result, body in _functions():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {result} RETURN {body}")
        names.append(signature.split("(")[0])
    # One generator over one text: Spark inlines it, so that a lateral use is no join.
    spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION split_lines(text string) RETURNS TABLE (line_no int, line string)
        RETURN SELECT posexplode(split(
            CASE WHEN endswith(text, '\\n') THEN substring(text, 1, length(text) - 1) ELSE text END, '\\n')) AS (n, t)""")
    spark.udtf.register("parse_html", udtf(_HtmlNodes, returnType=_RETURNS))
    spark.udtf.register("parse_xml", udtf(_XmlNodes, returnType=_RETURNS))
    spark.udf.register("format_return", format_return)
    return [*names, "split_lines", "parse_html", "parse_xml", "format_return"]

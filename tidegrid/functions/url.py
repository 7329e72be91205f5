"""Splitting, building and canonicalising web addresses."""

from pyspark.sql import functions as F

URL_PARTS = ["scheme", "host", "port", "user", "pass", "path", "extra"]

# Default ports, and the class of each known scheme.
DEFAULT_PORTS = {"http": 80, "https": 443, "ftp": 21, "gopher": 70}
SCHEME_CLASSES = [
    "ftp",
    "gopher",
    "http",
    "https",
    "file",
    "news",
    "mailto",
    "socks",
    "javascript",
    "vbscript",
    "res",
]

_SCHEME = r"([A-Za-z][A-Za-z0-9+.\-]*)"
_LOGIN = r"(?:([^:@/?#]*)(?::([^@/?#]*))?@)?"
_HOST = r"(\[[^\]]*\]|[^:/?#@]*)(?::(\d*))?"
URL_PATTERN = rf"(?s)\A{_SCHEME}:(?://{_LOGIN}{_HOST})?([^?#]*)(.*)\z"
# Characters that may not stand in an address, and those that also are not plain.
_UNSAFE = r"[\x00-\x20\x7f\"<>\\^`{|}]|[^\x00-\x7f]"
_SEPARATOR = "\u0001"


def _column(value):
    return F.col(value) if isinstance(value, str) else value


def crack_url(url, decode=False):
    """An address as a struct of scheme, host, port, user, pass, path and extra.

    `extra` runs from the first `?` or `#` to the end, a missing port is the
    default of the scheme, and text that is no address gives null.
    """
    url = _column(url)
    # One pass of the pattern, its groups joined by a character no address has.
    groups = _SEPARATOR.join(f"${i}" for i in (1, 4, 5, 2, 3, 6, 7))
    parts = F.split(F.regexp_replace(url, URL_PATTERN, groups), _SEPARATOR)
    part = {name: F.get(parts, F.lit(i)) for i, name in enumerate(URL_PARTS)}
    scheme = F.lower(part["scheme"])
    port = F.coalesce(F.when(part["port"] != "", part["port"].try_cast("int")), default_port(scheme))

    def text(name):
        return (unescape(part[name]) if decode and name in ("path", "extra", "user", "pass") else part[name]).alias(name)

    struct = F.struct(
        scheme.alias("scheme"), text("host"), port.alias("port"), *[text(n) for n in ("user", "pass", "path", "extra")]
    )
    clean = ~F.contains(url, F.lit(_SEPARATOR))
    return F.when(clean & (F.size(parts) == len(URL_PARTS)), struct)


def default_port(scheme):
    """The usual port of a scheme, null where it has none."""
    port = F.lit(None).cast("int")
    for name, number in DEFAULT_PORTS.items():
        port = F.when(scheme == name, number).otherwise(port)
    return port


def create_url(scheme, host, port=None, path=None, user=None, password=None, extra=None, escape=False):
    """An address from its parts; the default port of the scheme is left out."""
    scheme, host = _column(scheme), _column(host)
    user, password, path, extra = (
        F.lit("") if c is None else F.coalesce(_column(c), F.lit("")) for c in (user, password, path, extra)
    )
    if escape:
        path, extra = escape_unsafe(path), escape_unsafe(extra)
    secret = F.when(password != "", F.concat(F.lit(":"), password)).otherwise("")
    login = F.when(user != "", F.concat(user, secret, F.lit("@"))).otherwise("")
    shown = F.lit("")
    if port is not None:
        port = _column(port)
        usual = default_port(F.lower(scheme))
        shown = F.when(port.isNull() | (port == 0) | port.eqNullSafe(usual), "").otherwise(
            F.concat(F.lit(":"), port.cast("string"))
        )
    bare = (F.coalesce(host, F.lit("")) == "") & ~F.lower(scheme).isin("http", "https", "ftp", "file")
    slashes = F.when(bare, ":").otherwise("://")
    return F.concat(scheme, slashes, login, F.coalesce(host, F.lit("")), shown, path, extra)


def create_url_from_struct(parts, escape=False):
    """An address from the struct that `crack_url` gives."""
    p = _column(parts)
    return create_url(
        *[p.getField(n) for n in ("scheme", "host", "port", "path", "user", "pass", "extra")], escape=escape
    )


def create_url_from_map(parts, escape=False):
    """An address from a map of part names, in any case, to texts."""
    folded = F.transform_keys(_column(parts), lambda k, _: F.lower(k))
    p = {n: F.try_element_at(folded, F.lit(n)) for n in URL_PARTS}
    return create_url(
        p["scheme"], p["host"], p["port"].try_cast("int"), p["path"], p["user"], p["pass"], p["extra"], escape=escape
    )


def url_scheme_class(url):
    """The scheme of an address if it is a known one, else `unknown` or `partial`."""
    scheme = F.lower(F.regexp_extract(_column(url), rf"\A{_SCHEME}:", 1))
    return F.when(scheme == "", "partial").when(scheme.isin(SCHEME_CLASSES), scheme).otherwise("unknown")


def escape_unsafe(text, pattern=_UNSAFE):
    """Percent escapes, by UTF-8 byte, for the characters that match `pattern`."""
    text = _column(text)
    each = F.transform(
        F.split(text, r"(?s)(?<=.)(?=.)"),
        lambda c: F.when(c.rlike(pattern), F.regexp_replace(F.hex(c), "(..)", r"%$1")).otherwise(c),
    )
    return F.when(text.rlike(pattern), F.array_join(each, "")).otherwise(text)


def unescape(text):
    """Text with its percent escapes resolved; null where one is malformed."""
    return F.try_url_decode(F.replace(_column(text), F.lit("+"), F.lit("%2B")))


def remove_dot_segments(path):
    """A path without `.` and `..` steps."""
    steps = F.split(path, "/")
    last = F.element_at(steps, -1)
    # A path that ends in a dot step names a folder.
    closed = F.when(last.isin(".", ".."), F.concat(steps, F.array(F.lit("")))).otherwise(steps)
    kept = F.aggregate(
        closed,
        F.array().cast("array<string>"),
        lambda out, s: F.when(s == ".", out)
        .when((s == "..") & (F.size(out) > 1), F.slice(out, F.lit(1), F.size(out) - 1))
        .when(s == "..", out)
        .otherwise(F.concat(out, F.array(s))),
    )
    return F.when(path.rlike(r"(\A|/)\.{1,2}(/|\z)"), F.array_join(kept, "/")).otherwise(path)


def canonicalize_url(
    url, decode=False, encode_percent=False, encode_spaces_only=False, no_encode=False, no_meta=False, browser_mode=False
):
    """An address in its canonical form.

    Unsafe characters become escapes, `.` and `..` steps are resolved and white
    space at the end is removed. The options change one step each: escapes are
    decoded first; percent signs are escaped too; only spaces are escaped;
    nothing is escaped; dot steps stay; text from `?` or `#` on stays as it is.
    """
    url = _column(url)
    url = F.when(url.rlike(r"[?#]"), url).otherwise(F.rtrim(url)) if browser_mode else F.rtrim(url)
    if decode:
        url = F.coalesce(unescape(url), url)
    head = F.regexp_extract(url, r"(?s)\A([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/?#]*)?)?([^?#]*)(.*)\z", 1)
    path = F.regexp_extract(url, r"(?s)\A([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/?#]*)?)?([^?#]*)(.*)\z", 2)
    extra = F.regexp_extract(url, r"(?s)\A([A-Za-z][A-Za-z0-9+.\-]*:(?://[^/?#]*)?)?([^?#]*)(.*)\z", 3)
    if not no_meta:
        path = remove_dot_segments(path)

    def encode(text):
        if no_encode:
            return text
        if encode_percent:
            text = F.replace(text, F.lit("%"), F.lit("%25"))
        return F.replace(text, F.lit(" "), F.lit("%20")) if encode_spaces_only else escape_unsafe(text)

    return F.concat(head, encode(path), extra if browser_mode else encode(extra))

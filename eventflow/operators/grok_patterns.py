"""Built-in grok patterns and their expansion to one regular expression."""

from __future__ import annotations

import re

from ..functions.regex import PatternError

# The built-in pattern library.
PATTERNS = {
    # base
    "USERNAME": r"[a-zA-Z0-9._-]+",
    "USER": r"%{USERNAME}",
    "EMAILLOCALPART": r"[a-zA-Z0-9_.+-]+",
    "EMAILADDRESS": r"%{EMAILLOCALPART}@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}",
    "INT": r"(?:[+-]?(?:[0-9]+))",
    "BASE10NUM": r"(?:[+-]?(?:[0-9]+(?:\.[0-9]+)?))",
    "NUMBER": r"%{BASE10NUM}",
    "BASE16NUM": r"(?:0[xX]?[0-9a-fA-F]+)",
    "WORD": r"\b\w+\b",
    "NOTSPACE": r"\S+",
    "SPACE": r"\s*",
    "DATA": r".*?",
    "GREEDYDATA": r".*",
    "QUOTEDSTRING": r'"(?:[^"\\]|\\.)*"',
    "UUID": r"[A-Fa-f0-9]{8}-(?:[A-Fa-f0-9]{4}-){3}[A-Fa-f0-9]{12}",
    # network
    "CISCOMAC": r"(?:[A-Fa-f0-9]{4}\.){2}[A-Fa-f0-9]{4}",
    "WINDOWSMAC": r"(?:[A-Fa-f0-9]{2}-){5}[A-Fa-f0-9]{2}",
    "COMMONMAC": r"(?:[A-Fa-f0-9]{2}:){5}[A-Fa-f0-9]{2}",
    "MAC": r"(?:%{CISCOMAC}|%{WINDOWSMAC}|%{COMMONMAC})",
    "IPV6": r"(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}",
    "IPV4": r"(?:(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)\.){3}(?:25[0-5]|2[0-4][0-9]|[01]?[0-9][0-9]?)",
    "IP": r"(?:%{IPV4}|%{IPV6})",
    "HOSTNAME": r"\b[0-9A-Za-z][0-9A-Za-z-]{0,62}(?:\.[0-9A-Za-z][0-9A-Za-z-]{0,62})*\.?",
    "HOST": r"%{HOSTNAME}",
    "IPORHOST": r"(?:%{IP}|%{HOSTNAME})",
    # paths
    "PATH": r"(?:/[^/\s]*)+",
    "UNIXPATH": r"(?:/[A-Za-z0-9_.-]+)+",
    "TTY": r"/dev/pts/\d+",
    "WINPATH": r"(?:[A-Za-z]:|\\)(?:\\[^\\?*]*)+",
    "URIPROTO": r"[A-Za-z]+(?:\+[A-Za-z+]+)?",
    "URIHOST": r"%{IPORHOST}(?::%{INT})?",
    "URIPATH": r"(?:/[A-Za-z0-9$.+!*'(){},~:;=@#%_\-]*)*",
    "URIPARAM": r"\?[A-Za-z0-9$.+!*'|(){},~@#%&/=:;_?\-\[\]<>]*",
    "URIPATHPARAM": r"%{URIPATH}(?:%{URIPARAM})?",
    "URI": r"%{URIPROTO}://(?:%{USER}:[^@]*@)?(?:%{URIHOST})?(?:%{URIPATHPARAM})?",
    # dates
    "MONTH": (
        r"\b(?:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|Jun(?:e)?|Jul(?:y)?|Aug(?:ust)?"
        r"|Sep(?:tember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)\b"
    ),
    "MONTHNUM": r"(?:0?[1-9]|1[0-2])",
    "MONTHDAY": r"(?:(?:0[1-9])|(?:[12][0-9])|(?:3[01])|[1-9])",
    "DAY": (
        r"(?:Mon(?:day)?|Tue(?:sday)?|Wed(?:nesday)?|Thu(?:rsday)?|Fri(?:day)?|Sat(?:urday)?|Sun(?:day)?)"
    ),
    "YEAR": r"(?:\d\d){1,2}",
    "HOUR": r"(?:2[0123]|[01]?[0-9])",
    "MINUTE": r"(?:[0-5][0-9])",
    "SECOND": r"(?:(?:[0-5]?[0-9]|60)(?:[:.,][0-9]+)?)",
    "TIME": r"%{HOUR}:%{MINUTE}(?::%{SECOND})",
    "ISO8601_TIMEZONE": r"(?:Z|[+-]%{HOUR}(?::?%{MINUTE}))",
    "ISO8601_SECOND": r"(?:%{SECOND}|60)",
    "TIMESTAMP_ISO8601": (
        r"%{YEAR}-%{MONTHNUM}-%{MONTHDAY}[T ]%{HOUR}:?%{MINUTE}(?::?%{SECOND})?%{ISO8601_TIMEZONE}?"
    ),
    "DATE_US": r"%{MONTHNUM}[/-]%{MONTHDAY}[/-]%{YEAR}",
    "DATE_EU": r"%{MONTHDAY}[./-]%{MONTHNUM}[./-]%{YEAR}",
    "DATESTAMP": r"%{DATE_US}|%{DATE_EU}",
    "TZ": r"(?:[PMCE][SD]T|UTC)",
    "DATESTAMP_RFC822": r"%{DAY} %{MONTH} %{MONTHDAY} %{YEAR}",
    "DATESTAMP_RFC2822": r"%{DAY}, %{MONTHDAY} %{MONTH} %{YEAR} %{TIME} %{ISO8601_TIMEZONE}",
    "DATESTAMP_OTHER": r"%{DAY} %{MONTH} %{MONTHDAY} %{TIME} %{TZ} %{YEAR}",
    "DATESTAMP_EVENTLOG": r"%{YEAR}%{MONTHNUM}%{MONTHDAY}%{HOUR}%{MINUTE}%{SECOND}",
    # syslog
    "SYSLOGTIMESTAMP": r"%{MONTH} +%{MONTHDAY} %{TIME}",
    "PROG": r"[\x21-\x5a\x5c\x5e-\x7e]+",
    "SYSLOGPROG": r"%{PROG:program}(?:\[%{INT:pid}\])?",
    "SYSLOGHOST": r"%{IPORHOST}",
    "SYSLOGFACILITY": r"<%{INT:facility}.%{INT:priority}>",
    "HTTPDATE": r"%{MONTHDAY}/%{MONTH}/%{YEAR}:%{TIME} %{INT}",
    # log level
    "LOGLEVEL": (
        r"(?:[Aa]lert|ALERT|[Tt]race|TRACE|[Dd]ebug|DEBUG|[Nn]otice|NOTICE|[Ii]nfo|INFO"
        r"|[Ww]arn?(?:ing)?|WARN?(?:ING)?|[Ee]rr?(?:or)?|ERR?(?:OR)?|[Cc]rit?(?:ical)?|CRIT?(?:ICAL)?"
        r"|[Ff]atal|FATAL|[Ss]evere|SEVERE|EMERG(?:ENCY)?|[Ee]merg(?:ency)?)"
    ),
    # http
    "HTTPMETHOD": r"\b(?:GET|HEAD|POST|PUT|DELETE|CONNECT|OPTIONS|TRACE|PATCH)\b",
    "HTTPVERSION": r"HTTP/%{NUMBER:http_version}",
    # access logs
    "COMMONAPACHELOG": (
        r'%{IP:client} %{USER:ident} %{USER:auth} \[%{HTTPDATE:timestamp}\] '
        r'"(?:%{HTTPMETHOD:method} %{NOTSPACE:request}(?: %{HTTPVERSION})?|%{DATA:rawrequest})" '
        r"%{NUMBER:status} (?:%{NUMBER:bytes}|-)"
    ),
    "COMBINEDAPACHELOG": r"%{COMMONAPACHELOG} %{QUOTEDSTRING:referrer} %{QUOTEDSTRING:agent}",
    # event records (the vendor-prefixed trio under neutral names)
    "EVENT_TIMESTAMP": r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(?:\.\d{3,9})?Z?",
    "EVENT_UUID": r"[a-f0-9]{8}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{4}-[a-f0-9]{12}",
    "EVENT_LOGLEVEL": r"(?:DEBUG|INFO|WARN|ERROR|FATAL)",
}

# Same languages, written so that Java's matcher keeps a shallow stack on long texts.
_JAVA_FORMS = {'(?:[^"\\\\]|\\\\.)*': '[^"\\\\]*(?:\\\\.[^"\\\\]*)*'}

_REFERENCE = re.compile(r"%\{([A-Z0-9_]+)(?::([a-z0-9_]+))?\}")


def expand(pattern: str, custom: dict[str, str] | None = None) -> str:
    """Pattern with every ``%{NAME}`` inlined and every ``%{NAME:field}`` a named group.

    Unknown names read as non-blank text.  A field name met a second time (a nested definition
    used twice) captures nothing further.
    """
    known = {**PATTERNS, **(custom or {})}
    used: set[str] = set()

    def inline(source: str, open_names: tuple[str, ...]) -> str:
        def one(match: re.Match) -> str:
            name, field = match.groups()
            if name in open_names:
                raise PatternError(f"circular pattern reference {name}")
            body = inline(known[name], (*open_names, name)) if name in known else r"\S+"
            if field and field not in used:
                used.add(field)
                return f"(?P<{field}>{body})"
            return f"(?:{body})" if field else body

        return _REFERENCE.sub(one, source)

    text = inline(pattern, ())
    for slow, quick in _JAVA_FORMS.items():
        text = text.replace(slow, quick)
    return text

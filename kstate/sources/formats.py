"""Formats by extension and by signature, as small tables."""

from __future__ import annotations

from functools import lru_cache

# Extension, format, media type, family, route, evidence (text, or the signature it needs).
EXTENSIONS = """
md        markdown          text/markdown                   text         markdown          text
markdown  markdown          text/markdown                   text         markdown          text
mdx       mdx               text/mdx                        text         markup            text
rst       rst               text/x-rst                      text         markup            text
tex       latex             application/x-latex             text         markup            text
html      html              text/html                       text         markup            text
htm       html              text/html                       text         markup            text
xml       xml               application/xml                 data         markup            text
svg       svg               image/svg+xml                   image        markup            text
txt       text              text/plain                      text         text              text
json      json              application/json                data         structured-text   text
jsonl     jsonl             application/x-ndjson            data         structured-text   text
yaml      yaml              application/yaml                data         structured-text   text
yml       yaml              application/yaml                data         structured-text   text
toml      toml              application/toml                data         structured-text   text
csv       csv               text/csv                        data         structured-text   text
tsv       tsv               text/tab-separated-values       data         structured-text   text
ipynb     jupyter-notebook  application/x-ipynb+json        data         structured-text   text
sql       sql               application/sql                 code         text-source       text
py        python            text/x-python                   code         text-source       text
js        javascript        text/javascript                 code         text-source       text
mjs       javascript        text/javascript                 code         text-source       text
cjs       javascript        text/javascript                 code         text-source       text
ts        typescript        text/typescript                 code         text-source       text
tsx       tsx               text/tsx                        code         text-source       text
jsx       jsx               text/jsx                        code         text-source       text
java      java              text/x-java-source              code         text-source       text
go        go                text/x-go                       code         text-source       text
rs        rust              text/x-rust                     code         text-source       text
c         c                 text/x-c                        code         text-source       text
h         c-header          text/x-c                        code         text-source       text
cpp       cpp               text/x-c++                      code         text-source       text
cc        cpp               text/x-c++                      code         text-source       text
hpp       cpp-header        text/x-c++                      code         text-source       text
sh        shell             application/x-sh                code         text-source       text
ps1       powershell        text/x-powershell               code         text-source       text
pdf       pdf               application/pdf                 document     pdf               pdf
docx      docx              application/vnd.openxmlformats-officedocument.wordprocessingml.document    document  office  zip
xlsx      xlsx              application/vnd.openxmlformats-officedocument.spreadsheetml.sheet          data      office  zip
pptx      pptx              application/vnd.openxmlformats-officedocument.presentationml.presentation  document  office  zip
odt       odt               application/vnd.oasis.opendocument.text          document  office  zip
ods       ods               application/vnd.oasis.opendocument.spreadsheet   data      office  zip
odp       odp               application/vnd.oasis.opendocument.presentation  document  office  zip
epub      epub              application/epub+zip            document     archive-document  zip
doc       doc               application/msword              document     office            ole
xls       xls               application/vnd.ms-excel        data         office            ole
ppt       ppt               application/vnd.ms-powerpoint   document     office            ole
rtf       rtf               application/rtf                 document     rich-text         rtf
zip       zip               application/zip                 archive      archive           zip
gz        gzip              application/gzip                archive      archive           gzip
bz2       bzip2             application/x-bzip2             archive      archive           bzip2
xz        xz                application/x-xz                archive      archive           xz
7z        7z                application/x-7z-compressed     archive      archive           7z
rar       rar               application/vnd.rar             archive      archive           rar
tar       tar               application/x-tar               archive      archive           tar
png       png               image/png                       image        image             png
jpg       jpeg              image/jpeg                      image        image             jpeg
jpeg      jpeg              image/jpeg                      image        image             jpeg
gif       gif               image/gif                       image        image             gif
webp      webp              image/webp                      image        image             webp
tif       tiff              image/tiff                      image        image             tiff
tiff      tiff              image/tiff                      image        image             tiff
wav       wav               audio/wav                       audio        audio             wav
mp3       mp3               audio/mpeg                      audio        audio             mp3
ogg       ogg               application/ogg                 audio-video  media             ogg
mp4       mp4               video/mp4                       video        video             mp4
sqlite    sqlite            application/vnd.sqlite3         database     database          sqlite
sqlite3   sqlite            application/vnd.sqlite3         database     database          sqlite
db        sqlite            application/vnd.sqlite3         database     database          sqlite
parquet   parquet           application/vnd.apache.parquet  data         binary-data       parquet
"""

# Format and the pattern of the first bytes in hex, tried in this order.
SIGNATURES = """
pdf      ^255044462D
png      ^89504E470D0A1A0A
jpeg     ^FFD8FF
gif      ^47494638(37|39)61
webp     ^52494646.{8}57454250
tiff     ^(49492A00|4D4D002A)
gzip     ^1F8B
bzip2    ^425A68
xz       ^FD377A585A00
7z       ^377ABCAF271C
rar      ^526172211A07(00|0100)
rtf      ^7B5C727466
sqlite   ^53514C69746520666F726D6174203300
parquet  ^50415231
wav      ^52494646.{8}57415645
ogg      ^4F676753
mp3      ^(494433|FF[EF])
mp4      ^.{8}66747970
"""
ZIP, OLE, TAR = "^504B(0304|0506|0708)", "^D0CF11E0A1B11AE1", "7573746172"
#: Formats without an extension of their own.
OTHER = (("ole-compound", "application/x-ole-storage", "binary", "binary"), ("binary", "application/octet-stream", "binary", "binary"))


@lru_cache(maxsize=1)
def extension_rows() -> tuple[tuple[str, ...], ...]:
    return tuple(tuple(line.split()) for line in EXTENSIONS.strip().splitlines())


@lru_cache(maxsize=1)
def format_rows() -> tuple[tuple[str, ...], ...]:
    """(format, media type, family, route), one row a format."""
    seen: dict[str, tuple[str, ...]] = {}
    for _, fmt, media, family, route, _ in extension_rows():
        seen.setdefault(fmt, (fmt, media, family, route))
    return tuple(seen.values()) + OTHER


def signature_rows() -> list[tuple[str, str]]:
    return [tuple(line.split()) for line in SIGNATURES.strip().splitlines()]  # type: ignore[misc]

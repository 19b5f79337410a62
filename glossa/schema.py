"""Schemas of the raw inputs and of the pipeline's tables."""

TOC = "entries array<struct<section: struct<title: string, uri: string, entries: array<struct<content: struct<uri: string, title: string, subtitle: string>>>>>>"
CONTENT = "meta struct<title: string, structuredData: string>, content struct<body: string, footnotes: map<string, struct<text: string, pid: string, context: string>>>"
REF = "year int, month int, uri string, slug string, title string, speaker string, session string, session_uri string, session_ord int, ord int"
BODY = "speaker_role string, speaker_name string, paragraphs array<struct<pid: string, ord: int, text: string>>, footnotes array<struct<marker: string, pid: string, ord: int, inline: boolean, raw_html: string, context: string>>"
OVERRIDE_AUTHORS = "ord int, canonical string, kind string, aliases array<string>"
OVERRIDE_WORKS = "ord int, canonical string, author string, type string, aliases array<string>"

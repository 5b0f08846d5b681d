"""Secret scans with corpus-wide ownership frequency.

Spans that look like secrets are found in every text. Their values' hashes are counted over the whole corpus by distinct
repositories and owners: a value that several owners hold is a copied example, one that stays with few owners and looks
random is a live credential. Values known to be live are then found wherever they occur without their context, too.

Kinds, in order: ``assign``, ``access``, ``hex`` (the base kinds, always reported), ``format`` (vendor prefixes, signed
tokens, key headers, passwords in addresses) and ``bare`` (a live value without context); the last two are reported only
if live, and only where they overlap no earlier kind, but private keys with their body always. A private key is one span
from its header to its end, counted by its body. Positions count code points, ends are exclusive.

All of it is column expressions, aggregations and joins. Defined cases: a null text is empty and has no spans; a null
owner or repository is an owner of its own; repeated rows count once per repository; an empty table gives an empty
result; columns that are not named do not matter. Texts may be long and hold any number of spans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from cohortlens.sources.scratch import written

#: Fixed patterns, readable by Java and RE2 alike.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
FORMAT = (
    r"(?:gh[pousr]_|glpat-|xox[abprs]-|[sr]k_live_|AIza|hf_|npm_)[A-Za-z0-9_-]{16,}"
    r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
    r"|-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"
    r"|://[^\x00-\x20/:@]{1,64}:[^\x00-\x20/:@]{6,64}@"
)
#: A private key as a block: its header, lines of the format and of base 64, as they are or quoted, and its end if it is
#: there. A header alone stays a candidate. Java only: the SQL reads headers by FORMAT.
_KEY_HEAD = r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"
_KEY_END = r"-----END [A-Z ]{0,30}PRIVATE KEY-----"
_KEY_LINE = r"[A-Z][A-Za-z]{0,20}(?:-[A-Za-z]{1,20})?: [^\r\n\\]{0,200}"
_BETWEEN = r"""(?:\\[nrt]|[\s"'+,;|#>*])"""
_KEY = (
    rf"{_KEY_HEAD}(?:(?:{_BETWEEN}{{1,80}}{_KEY_LINE}){{0,4}}(?:"
    rf"{_BETWEEN}{{0,80}}+[A-Za-z0-9+/=]{{16,}}+(?:{_BETWEEN}{{0,80}}+[A-Za-z0-9+/=]++){{0,400}}+{_BETWEEN}{{0,80}}+{_KEY_END}"
    rf"|(?:{_BETWEEN}{{0,80}}+[A-Za-z0-9+/=]{{32,}}+){{1,400}}+(?:{_BETWEEN}{{1,80}}+[A-Za-z0-9+/=]{{1,31}}+(?=\s*\z))?))?"
)
_FORMAT = FORMAT.replace(_KEY_HEAD, _KEY)
BARE = r"[A-Za-z0-9+/_=-]{16,}"
#: What a text with any candidate holds. Runs without a digit are no bare candidates; the test stands where a run begins.
_ANY = "|".join([ASSIGN, ACCESS, HEX, FORMAT, r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16}"])
LEAST_ASSIGNED = 6
KINDS = ("assign", "access", "hex", "format", "bare")
#: A value that this many owners hold is a copied example.
COPIED_OWNERS = 3
#: A live-looking value has this many different characters and none of the marks of a placeholder.
LEAST_DIFFERENT = 6
PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|test"
#: The owner and the repository of a document in the documents table.
OWNER = ("source",)
REPOSITORY = ("source", "lang")
REPLACEMENT = "[SECRET]"
#: As PLACEHOLDER, of words that a key's body holds by chance in less than 1 of 10,000 cases.
_KEY_PLACEHOLDER = r"(?i)example|sample|dummy|changeme|placeholder|x{8}"


#: Numbers that a running total takes at a time, and a place behind every text.
_BLOCK, _FAR = 128, 2**31 - 1
_HASHED = "struct<start:int,rank:int,kind:string,end:int,from:int,hash:string,random:boolean>"
_SPANS = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, the value computed once."""
    return F.transform(F.array(value), use)[0]


def _running(numbers: Column, join: Callable[[Column, Column], Column], zero: int) -> Column:
    """Running totals of a list of integers by an associative ``join``. Lists grow by copying, so totals are taken within
    blocks, then over the blocks: far from the square of the length for any text."""
    start = F.struct(F.lit(zero).alias("at"), F.array().cast("array<int>").alias("out"))

    def within(acc: Column, number: Column) -> Column:
        at = join(acc["at"], number)
        return F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out"))

    def before(acc: Column, block: Column) -> Column:
        return F.struct(join(acc["at"], block["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def blocks(each: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(each), F.lit(1)), F.lit(_BLOCK))
        return F.transform(firsts, lambda first: F.aggregate(F.slice(each, first, _BLOCK), start, within))

    def added(cut: Column) -> Column:
        offsets = F.aggregate(cut, start, before)["out"]
        return F.flatten(F.zip_with(cut, offsets, lambda block, at: F.transform(block["out"], lambda n: join(at, n))))

    return _once(_once(numbers, blocks), added)


def _matches(text: Column, pattern: str, kind: str) -> Column:
    """array<struct(start, rank, kind, end, value)>: pieces between matches and matches, their lengths summed up."""
    rank = KINDS.index(kind)

    def spans(match: Column) -> Column:
        piece = F.slice(F.split(text, pattern, -1), 1, F.size(match))
        ends = _running(F.zip_with(piece, match, lambda p, m: F.length(p) + F.length(m)), lambda x, y: x + y, 0)
        return F.zip_with(ends, match, lambda end, m: F.struct(
            (end - F.length(m)).alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), m.alias("value"),
        ))

    found = _once(F.regexp_extract_all(text, F.lit(pattern), 0), spans)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_SPANS))


def _free_of(own: Column, others: Column) -> Column:
    """The spans of ``own`` that overlap none of ``others``, in order: all are sorted once, then each is held against how far
    the others before it reach and where the next one starts."""

    def tagged(spans: Column, mine: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(mine).alias("mine"), s.alias("span")))

    def free(every: Column) -> Column:
        reach = _running(F.transform(every, lambda s: F.when(s["mine"], F.lit(0)).otherwise(s["end"])), F.greatest, 0)
        starts = F.transform(every, lambda s: F.when(s["mine"], F.lit(_FAR)).otherwise(s["start"]))
        ahead = F.reverse(_running(F.reverse(starts), F.least, _FAR))
        around = F.zip_with(reach, ahead, lambda r, n: F.struct(r.alias("reach"), n.alias("next")))
        judged = F.zip_with(every, around, lambda s, o: F.struct(
            s["span"].alias("span"), (s["mine"] & (o["reach"] <= s["start"]) & (o["next"] >= s["end"])).alias("free")
        ))
        return F.transform(F.filter(judged, lambda s: s["free"]), lambda s: s["span"])

    some = (F.size(own) > 0) & (F.size(others) > 0)
    return F.when(some, _once(F.sort_array(F.concat(tagged(own, True), tagged(others, False))), free)).otherwise(own)


def _is_block(value: Column) -> Column:
    return value.rlike(f"(?s)^{_KEY_HEAD}.")


def _identity(value: Column) -> Column:
    """What a value is counted by: itself, of a private key the base 64 text of its body, however it is broken or quoted."""
    body = F.regexp_replace(value, f"{_KEY_HEAD}|{_KEY_END}|{_KEY_LINE}", "")
    return F.when(_is_block(value), F.regexp_replace(body, r"\\[nrt]|[^A-Za-z0-9/=]", "")).otherwise(value)


def _live_looking(value: Column) -> Column:
    different = F.size(F.array_distinct(F.split(_identity(value), "")))
    placeholder = F.when(_is_block(value), _identity(value).rlike(_KEY_PLACEHOLDER)).otherwise(value.rlike(PLACEHOLDER))
    return (different >= LEAST_DIFFERENT) & ~placeholder


def candidates(text: Column) -> Column:
    """array<struct(start, rank, kind, end, value)> of all kinds, values being the secret part, unsorted."""
    whole = F.coalesce(text, F.lit(""))
    assigned = F.transform(
        _matches(whole, ASSIGN, "assign"), lambda s: s.withField("value", F.regexp_extract(s["value"], ASSIGN, 2))
    )
    base = F.concat(
        F.filter(assigned, lambda s: F.length(s["value"]) >= LEAST_ASSIGNED),
        _matches(whole, ACCESS, "access"), _matches(whole, HEX, "hex"),
    )
    bare = F.filter(_matches(whole, BARE, "bare"), lambda s: s["value"].rlike("[0-9]"))
    every = F.concat(base, _matches(whole, _FORMAT, "format"), bare)
    return F.when(may_hold(text), every).otherwise(F.array().cast(_SPANS))


def may_hold(text: Column) -> Column:
    """Whether a text has any candidate at all: one scan that spares most texts the others."""
    return F.coalesce(text.rlike(_ANY), F.lit(False))


def _located(docs: DataFrame) -> DataFrame:
    """The documents with ``__spans``, in order: start, rank, kind, end, from (where the value starts), hash, random."""
    found = docs.withColumn("__all", candidates(F.col("text")))
    base = F.filter("__all", lambda s: s["rank"] < 3)
    # A key's block stays where an earlier kind takes a part of it, such as the header after "secret =".
    blocks = F.filter("__all", lambda s: (s["rank"] == 3) & _is_block(s["value"]))
    formats = _free_of(F.filter("__all", lambda s: (s["rank"] == 3) & ~_is_block(s["value"])), base)
    found = found.withColumn("__context", F.concat(base, blocks, formats))
    spans = F.concat("__context", _free_of(F.filter("__all", lambda s: s["rank"] == 4), F.col("__context")))
    hashed = F.transform(
        spans, lambda s: F.struct(
            s["start"].alias("start"), s["rank"].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"),
            (s["end"] - F.length(s["value"])).alias("from"), F.sha2(_identity(s["value"]), 256).alias("hash"),
            _live_looking(s["value"]).alias("random"),
        )
    )
    return found.withColumn("__spans", F.array_sort(hashed)).drop("__all", "__context")


def _found(docs: DataFrame, owner: tuple[str, ...], repository: tuple[str, ...]) -> DataFrame:
    slim = _named(docs, owner, repository).select("doc_id", "text", "__owner", "__repository")
    return _located(slim).select(
        "doc_id", F.col("__owner").alias("owner"), F.col("__repository").alias("repository"), F.col("__spans").alias("spans")
    )


def _named(docs: DataFrame, owner: tuple[str, ...], repository: tuple[str, ...]) -> DataFrame:
    name = lambda columns: F.to_json(F.struct(*columns))
    return docs.withColumns({"__owner": name(owner), "__repository": name(repository)})


def value_owners(found: DataFrame) -> DataFrame:
    """Per candidate hash: distinct owners and repositories, whether it occurs in context, whether it is live."""
    seen = found.select("owner", "repository", F.explode("spans").alias("s")).select(
        "owner", "repository", F.col("s.hash").alias("hash"), (F.col("s.rank") < 4).alias("context"), F.col("s.random").alias("random")
    )
    by_repository = seen.groupBy("hash", "owner", "repository").agg(F.max("context").alias("context"), F.max("random").alias("random"))
    by_owner = by_repository.groupBy("hash", "owner").agg(
        F.count("*").alias("repositories"), F.max("context").alias("context"), F.max("random").alias("random")
    )
    values = by_owner.groupBy("hash").agg(
        F.count("*").alias("owners"), F.sum("repositories").alias("repositories"), F.max("context").alias("context"),
        F.max("random").alias("random"),
    )
    return values.withColumn("live", F.col("context") & F.col("random") & (F.col("owners") < COPIED_OWNERS))


def _set_key(spans: str) -> Column:
    """Digest of a row's distinct hashes; null if it has none."""
    hashes = F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["hash"])))
    return F.when(F.size(spans) > 0, F.sha2(F.array_join(hashes, ""), 256))


def _live_sets(found: DataFrame) -> DataFrame:
    """(__set, __live): the live hashes of every set of hashes that some document has.

    Equal sets are looked up once, so a document copied to many rows costs one row here.
    """
    keyed = found.where(F.size("spans") > 0).withColumn("__set", _set_key("spans"))
    sets = keyed.groupBy("__set").agg(F.first(F.transform("spans", lambda s: s["hash"])).alias("hashes"))
    each = sets.select("__set", F.explode(F.array_distinct("hashes")).alias("hash"))
    live = each.join(value_owners(found).where("live").select("hash"), "hash")
    return live.groupBy("__set").agg(F.sort_array(F.collect_list("hash")).alias("__live"))


def _judged(rows: DataFrame, live: DataFrame, spans: str) -> DataFrame:
    """``rows`` with ``__live``, an empty list where nothing is live. Rows without spans, the most, take no join."""
    none = F.array().cast("array<string>")
    without = rows.where(F.size(spans) == 0).withColumn("__live", none)
    joined = rows.where(F.size(spans) > 0).withColumn("__set", _set_key(spans)).join(live, "__set", "left")
    return joined.withColumn("__live", F.coalesce("__live", none)).drop("__set").unionByName(without)


def _verdicts(spans: Column, live: Column) -> Column:
    """The spans in order, each with ``live``: whether its hash is among the live ones. Both are sorted by hash once, a live
    hash before its spans."""

    def said(every: Column) -> Column:
        places = F.transform(every, lambda e, i: F.when(e["span"].isNull(), i).otherwise(F.lit(-1)))
        latest = _running(places, F.greatest, -1)
        judged = F.zip_with(every, latest, lambda e, at: F.when(
            e["span"].isNotNull(), e["span"].withField("live", F.coalesce(F.get(every, at)["hash"] == e["hash"], F.lit(False)))
        ))
        return F.sort_array(F.filter(judged, lambda s: s.isNotNull()))

    none = F.lit(None).cast(_HASHED)
    hashes = F.transform(live, lambda h: F.struct(h.alias("hash"), F.lit(0).alias("after"), none.alias("span")))
    tagged = F.transform(spans, lambda s: F.struct(s["hash"].alias("hash"), F.lit(1).alias("after"), s.alias("span")))
    plain = F.transform(spans, lambda s: s.withField("live", F.lit(False)))
    return F.when(F.size(live) > 0, _once(F.sort_array(F.concat(hashes, tagged)), said)).otherwise(plain)


def _reported(spans: str) -> Column:
    """Base spans and the live ones of the other kinds, each with its verdict, in order."""
    return F.filter(_verdicts(F.col(spans), F.col("__live")), lambda s: (s["rank"] < 3) | s["live"])


def secrets(docs: DataFrame, owner: tuple[str, ...] = OWNER, repository: tuple[str, ...] = REPOSITORY) -> DataFrame:
    """Per document: doc_id and ``spans``, array<struct(start, rank, kind, end, from, hash, random, live)> in order."""
    found = written(_found(docs, owner, repository), "secrets")
    return _judged(found, _live_sets(found), "spans").select("doc_id", _reported("spans").alias("spans"))


def digest(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, owner: tuple[str, ...] = OWNER, repository: tuple[str, ...] = REPOSITORY) -> DataFrame:
    """The documents with the value of every live secret replaced; copied examples and all other text stay.

    Only documents with candidates are written apart and meet the verdicts; the others pass without a shuffle.
    """
    columns = docs.columns
    clean = docs.where(~may_hold(F.col("text")))
    located = written(_located(_named(docs.where(may_hold(F.col("text"))), owner, repository)), "secret-candidates")
    live = _live_sets(located.select(F.col("__owner").alias("owner"), F.col("__repository").alias("repository"), F.col("__spans").alias("spans")))
    judged = _judged(located, live, "__spans")
    cuts = F.array_sort(F.transform(
        F.filter(_verdicts(F.col("__spans"), F.col("__live")), lambda s: s["live"]),
        lambda s: F.struct(s["from"].alias("from"), s["end"].alias("end")),
    ))

    def step(acc: Column, cut: Column) -> Column:
        before = F.substring(F.col("text"), acc["at"] + 1, cut["from"] - acc["at"])
        added = F.when(cut["from"] >= acc["at"], F.concat(acc["out"], before, F.lit(REPLACEMENT))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], cut["end"]).alias("at"), added.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    end = F.aggregate(cuts, start, step, lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text"))))
    rewritten = judged.withColumn("text", F.when(F.size("__live") > 0, end).otherwise(F.col("text")))
    if "n_chars" in columns:
        rewritten = rewritten.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.unionByName(rewritten.select(*columns))

"""The operators of this package as queries over the given tables, with their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entiledger.llm import (
    ann,
    bpe,
    chat,
    decontaminate,
    licenses,
    merkle,
    pii,
    quality,
    secrets,
    simhash,
    spelling,
    tokens,
    urls,
)
from entiledger.llm.common import cut, read
from entiledger.operators.joins import lookup_join

TOKENIZER = "byte_bpe_50k.json"
VERSIONS = ("byte_bpe_50k", "byte_bpe_multi_50k")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms, and how many values of each format they replace."""
    found = pii.pseudonymise(read(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(name: str) -> Column:
        return F.size(F.filter("pii", lambda kind: kind == name)).alias(f"n_{name}")

    return found.select("doc_id", "text", *map(count, pii.FORMATS))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contamination of every document by the benchmark."""
    found = decontaminate.overlaps(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), 13
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_words"), F.col("n_hit")).alias(
            "contaminated"
        ),
    )


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered conversations that no longer one begins with."""
    return chat.collapsed(read(spark, sf_dir, "conversations"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded text of every document."""
    vocabulary = bpe.share(spark, public_tokenizers.path(TOKENIZER))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, vocabulary)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learnt from four fifths of the labels."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        quality.accepted(F.col("score")).cast("int").alias("predicted"),
    )


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every vector whose id is divisible by 50."""
    vectors = read(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), 5)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and places of the secrets of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs)

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])),
            ",",
        )

    def of(kind: str) -> Column:
        return F.filter("secrets", lambda s: s["kind"] == kind)

    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after four batches over all documents, one of them sent twice.

    All documents come in with counts estimated at four characters a token, the estimates
    are revised to the tokenizer's counts, the counts of a second tokenizer come in, and
    documents whose text another one has are deleted under both: one of each text stays,
    that of the smallest doc_id (null last), source and lang, also if rows repeat.
    """
    docs = read(spark, sf_dir, "documents")
    files = {v: public_tokenizers.path(f"{v}.tiktoken") for v in VERSIONS}
    counted = tokens.counted(docs, files, public_tokenizers.PATTERN)
    first, second = (F.col("n_tokens")[v] for v in VERSIONS)
    rows = cut(
        counted.select(
            "doc_id",
            "source",
            "lang",
            F.sha2(F.coalesce("text", F.lit("")), 256).alias("key"),
            F.expr("coalesce(n_chars, 0) div 4").alias("guess"),
            F.monotonically_increasing_id().alias("row"),
            first.alias("first"),
            second.alias("second"),
        )
    )
    place = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "source", "lang", "row")
    kept = rows.groupBy("key").agg(F.min(place)["row"].alias("kept"))
    copies = lookup_join(rows, kept, "key", "inner", ["row"]).where("row <> kept")
    old, new = VERSIONS
    revised = tokens.revisions(rows, old, F.col("guess"), F.col("first"))
    gone = tokens.changes(copies, old, -1, F.col("first")).union(
        tokens.changes(copies, new, -1, F.col("second"))
    )
    rollup = tokens.scratch(spark)
    rollup.commit("1-loaded", tokens.changes(rows, old, 1, F.col("guess")))
    rollup.commit("2-counted", revised)
    rollup.commit("3-second", tokens.changes(rows, new, 1, F.col("second")))
    rollup.commit("2-counted", revised)
    rollup.commit("4-copies", gone)
    totals = cut(rollup.totals())
    rollup.drop()
    return totals


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"), 3, 3)
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict for every page."""
    return urls.judged(read(spark, sf_dir, "pages"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases, licenses and their evidence in every document."""
    found = licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    places, spans = F.col("licenses.places"), F.col("licenses.spans")

    def listed(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        F.col("licenses.n_words").alias("n_words"),
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places["start"]).alias("first_word"),
        F.array_max(places["start"]).alias("last_word"),
        listed(places["label"]).alias("base_labels"),
        listed(F.concat(places["label"], spans["label"])).alias("labels"),
        F.col("licenses.score").alias("score"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, some of which lose a letter."""
    runs = spelling.runs(read(spark, sf_dir, "documents"))
    slipped = spelling.slipped(F.col("doc_id"), F.col("run"), 97)
    words = spelling.counted(runs, slipped, 5, 3)
    return spelling.variants(words, 2)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof, half of them folded without their line feeds."""
    docs = read(spark, sf_dir, "documents")
    marked = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    bare = F.replace("text", F.lit("\n"), F.lit(""))
    tampered = F.when(marked, bare).otherwise(F.col("text"))
    found = merkle.manifest(docs, changed={"text": tampered})
    siblings = F.flatten(F.transform("proof", lambda level: level["others"]))
    return found.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join(siblings, ""), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii,
        op2_decontaminate,
        op3_chat,
        op4_bpe,
        op5_quality,
        op6_ann,
        op7_secrets,
        op8_token_counts,
        op9_simhash,
        op10_urls,
        op11_licenses,
        op12_spelling,
        op13_merkle,
    )
}


def _crc32(text: str) -> str:
    """SQL of the unsigned crc32 of a text in UTF-8; a null if it is null."""
    octets = (
        f"list_transform(range(strlen({text})), "
        f"lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)"
    )
    bits = "lambda x, y: xor(x >> 1, 3988292384 * (x & 1))"
    step = f"lambda c, o: list_reduce([xor(c, o), 0, 0, 0, 0, 0, 0, 0, 0], {bits})"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {octets}), {step}))"


_SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, '{spelling.UPPER}', '{spelling.LOWER}'), '[a-zÀ-ÿ]+')) AS run
  FROM documents),
marked AS (
  SELECT run, n, {_crc32("(doc_id::VARCHAR || ':' || run)")} AS h
  FROM (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL)),
slipped AS (
  SELECT n, CASE WHEN h % 97 = 0
      THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
      ELSE run END AS word
  FROM marked),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM slipped
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
shorter AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM shorter a JOIN shorter b USING (i, rest)
    WHERE a.word <> b.word
  UNION SELECT word, rest FROM shorter WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM shorter WHERE rest IN (SELECT word FROM words)),
best AS (
  SELECT near.word, count(*) AS n_near,
    first(other ORDER BY o.n DESC, other) AS other, max(o.n) AS other_n
  FROM near JOIN words o ON o.word = other GROUP BY near.word),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= 2 * n THEN other END AS form,
    CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
steps AS (
  SELECT word, word AS root, form AS ahead FROM formed
  UNION ALL
  SELECT s.word, f.word, f.form FROM steps s JOIN formed f ON f.word = s.ahead)
SELECT word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, root FROM steps WHERE ahead IS NULL) USING (word)"""


def _leaf_sql(text: str) -> str:
    """SQL of the digest of a document with the given text."""
    parts = [
        f"coalesce(strlen({c}) || ':' || {c}, '-')"
        for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
    ]
    return f"sha256({' || '.join(parts)})"


def _tree_sql(leaves: str) -> str:
    """SQL of the nodes (lvl, part, pos, h, size) of the trees over given leaves."""
    return f"""
  SELECT 0 AS lvl, part, pos, h, count(*) OVER (PARTITION BY part) AS size FROM {leaves}
  UNION ALL
  SELECT lvl + 1, part, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (size + 2) // 3
  FROM NODES WHERE size > 1 GROUP BY lvl, part, pos // 3, size"""


_MERKLE = f"""
WITH RECURSIVE plain AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
    CASE WHEN {_crc32("(doc_id::VARCHAR)")} % 2 = 0
      THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS fresh
  FROM documents),
leaves AS MATERIALIZED (
  SELECT *, leaf AS h, row_number() OVER () AS id,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS part,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM plain),
node AS ({_tree_sql("leaves").replace("NODES", "node")}),
subroots AS MATERIALIZED (
  SELECT 0 AS part, part AS pos, h FROM node WHERE size = 1),
upper AS ({_tree_sql("subroots").replace("NODES", "upper")}),
below AS (
  SELECT id, lvl, n.pos AS place, (l.pos // (3 ** lvl)::BIGINT) AS own, n.h
  FROM leaves l JOIN node n ON n.part = l.part AND size > 1
    AND n.pos // 3 = l.pos // (3 ** (lvl + 1))::BIGINT),
above AS (
  SELECT id, lvl, n.pos, (l.part // (3 ** lvl)::BIGINT), n.h
  FROM leaves l JOIN upper n ON size > 1 AND n.pos // 3 = l.part // (3 ** (lvl + 1))::BIGINT),
steps AS (
  SELECT id, tier, lvl,
    coalesce(string_agg(h, '' ORDER BY place) FILTER (place < own), '') AS before,
    coalesce(string_agg(h, '' ORDER BY place) FILTER (place > own), '') AS behind
  FROM (SELECT 0 AS tier, * FROM below UNION ALL SELECT 1, * FROM above)
  GROUP BY id, tier, lvl),
proofs AS (
  SELECT id, string_agg(before || behind, '' ORDER BY tier, lvl) AS proof,
    list(before || '|' || behind ORDER BY tier, lvl) AS sides
  FROM steps GROUP BY id),
folded AS (
  SELECT doc_id, leaf, s.h AS subroot,
    (SELECT h FROM upper WHERE size = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend(fresh, coalesce(sides, [])),
      lambda v, x: sha256(split_part(x, '|', 1) || v || split_part(x, '|', 2))) AS folded_root
  FROM leaves l JOIN subroots s ON s.pos = l.part LEFT JOIN proofs USING (id))
SELECT *, folded_root = root AS verified FROM folded"""


def _url_sql() -> str:
    """SQL of op10_urls, the rounds in a recursion."""
    kept = urls.SCALE * urls.RESTART // 20

    def moved(c: str) -> str:
        change = f"abs({c} - old_{c})"
        return f"({change} * {urls.MOVED_PART} > {c} AND {change} > {urls.MOVED_LEAST})"

    def rank(seed: str, got: str) -> str:
        passed = f"coalesce({got}, 0) * {20 - urls.RESTART}"
        return f"(({seed} * {urls.RESTART} + {passed}) // 20)::BIGINT"

    link = urls.LINK.replace("'", "''")
    tests = []
    for verdict, domain, start in sorted(urls.RULES, key=lambda r: -len(r[1] + r[2])):
        fits = (
            f"(host = '{domain}' OR ends_with(host, '.{domain}')) "
            f"AND starts_with(path, '{start}')"
        )
        tests.append((fits, domain + start, verdict))
    rule = " ".join(f"WHEN {t} THEN '{r}'" for t, r, _ in tests)
    verdict = " ".join(f"WHEN {t} THEN '{v}'" for t, _, v in tests)
    lower = f"'{urls.UPPER}', '{urls.LOWER}'"
    return f"""
WITH RECURSIVE parts AS MATERIALIZED (
  SELECT page_id, html,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), {lower}), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS MATERIALIZED (
  SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS verdict FROM parts),
links AS MATERIALIZED (
  SELECT DISTINCT src, dst FROM (
    SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), {lower}) AS dst
    FROM parts)
  WHERE src <> '' AND src <> dst),
shares AS (
  SELECT host, count(*) AS n, count(*) FILTER (verdict = 'allow') AS trust,
    count(*) FILTER (verdict = 'block') AS distrust
  FROM ruled WHERE host <> '' GROUP BY host),
start AS (
  SELECT 'trust' AS kind, host, trust * {urls.SCALE} // n AS seed FROM shares
  UNION ALL SELECT 'distrust', host, distrust * {urls.SCALE} // n FROM shares),
flow AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY kind, src) AS degree FROM (
    SELECT 'trust' AS kind, src, dst FROM links
    UNION ALL SELECT 'distrust', dst, src FROM links)),
seeded AS MATERIALIZED (
  SELECT kind, host, max(seed)::BIGINT AS seed FROM (
    SELECT * FROM start UNION ALL SELECT kind, dst, 0 FROM flow
    UNION ALL SELECT kind, src, 0 FROM flow) GROUP BY ALL),
state AS (
  SELECT 0 AS turn, kind, host, seed, {rank("seed", "0")} AS rank,
    {kept}::BIGINT AS base, EXISTS (FROM flow) AS going
  FROM seeded
  UNION ALL
  SELECT turn + 1, kind, host, seed, rank, base,
    bool_or({moved("rank")} OR {moved("base")}) OVER ()
  FROM (
    SELECT s.turn, s.kind, s.host, s.seed, s.rank AS old_rank, s.base AS old_base,
      {rank("s.seed", "g.rank")} AS rank, {rank(str(urls.SCALE), "g.base")} AS base
    FROM state s LEFT JOIN (
      SELECT f.kind, f.dst AS host, sum(p.rank // f.degree) AS rank,
        sum(p.base // f.degree) AS base
      FROM flow f JOIN state p ON f.kind = p.kind AND f.src = p.host
      GROUP BY ALL) g ON s.kind = g.kind AND s.host = g.host
    WHERE s.turn % {urls.CUT_EVERY} <> 0 OR s.going)),
held AS (
  SELECT kind, host, rank, base - {kept} + {kept} * max(CASE WHEN seed > 0 THEN 1 ELSE 0 END)
      OVER (PARTITION BY host) AS evidence
  FROM state WHERE turn = (SELECT max(turn) FROM state)),
shares_of AS (
  SELECT host, kind, CASE WHEN evidence > 0 THEN rank::DOUBLE / evidence::DOUBLE ELSE 0 END
    AS share FROM held),
bad AS (
  SELECT host FROM shares_of GROUP BY host
  HAVING coalesce(max(share) FILTER (kind = 'distrust'), 0)
      > coalesce(max(share) FILTER (kind = 'trust'), 0)
    AND max(share) FILTER (kind = 'distrust') >= 0.5)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN host IN (FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled"""


SQL: dict[str, str] = {
    "op2_decontaminate": f"""
WITH items AS (
  SELECT item_id::VARCHAR AS item, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{decontaminate.UPPER}', '{decontaminate.LOWER}'),
    '{decontaminate.GAP}'), lambda w: w <> '') AS words
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, words[spot:spot + 12] AS words
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS spot
        FROM items WHERE len(words) > 0)),
docs AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{decontaminate.UPPER}', '{decontaminate.LOWER}'),
    '{decontaminate.GAP}'), lambda w: w <> '') AS words
  FROM documents),
sizes AS (SELECT DISTINCT len(words) AS size FROM windows),
places AS (
  SELECT doc_id, spot, words[spot:spot + size - 1] AS words
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS spot
        FROM docs, sizes)),
found AS (
  SELECT doc_id, spot, len(words) AS size, item FROM places JOIN windows USING (words)),
hits AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(spot, spot + size)) AS place FROM found)
  GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN listed USING (doc_id)""",
    "op3_chat": f"""
WITH turns AS (
  SELECT conv_id, turn, role, text,
    sha256(concat(coalesce(length(role) || ':' || role, '-'), coalesce('t' || text, '-')))
      AS digest
  FROM conversations WHERE conv_id IS NOT NULL),
parts AS (
  SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1)
    // {chat.BLOCK} AS part
  FROM turns),
rolling AS (
  SELECT conv_id, string_agg(digest, ',') OVER w AS said,
    count(*) OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS size
  FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest
    ROWS UNBOUNDED PRECEDING)),
kept AS (
  SELECT min(conv_id) AS conv_id FROM rolling
  WHERE pos = size AND said NOT IN (SELECT said FROM rolling WHERE pos < size)
  GROUP BY said)
SELECT conv_id, part, count(*) AS n_turns,
  string_agg('{chat.OPEN}' || coalesce(role, '') || chr(10)
    || replace(coalesce(text, ''), '<|', '< |') || '{chat.CLOSE}', chr(10)
    ORDER BY turn NULLS FIRST, digest) AS text
FROM parts JOIN kept USING (conv_id) GROUP BY conv_id, part""",
    "op10_urls": _url_sql(),
    "op12_spelling": _SPELLING,
    "op13_merkle": _MERKLE,
}

"""A Merkle manifest of a dataset: one tree per source, one tree over the sources, and a proof for every row.

A node is labelled with the interval [lo, hi) of leaf ranks it covers. Intervals nest: an ancestor of a node is the
node of a higher level whose interval contains the node's own, and siblings are what remains of the parent's
interval when the node's own is taken away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import null_safe, ordered, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def encoded(value: Column) -> Column:
    """A value so that values in a row cannot run together: byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda node: node["digest"]), "")


def siblings(children: Column, lo: Column, hi: Column) -> Column:
    """The digests left and right of [lo, hi) in the parent's interval."""
    left = F.filter(children, lambda node: node["hi"] <= lo)
    right = F.filter(children, lambda node: node["lo"] >= hi)
    return F.struct(joined(left).alias("left"), joined(right).alias("right"))


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up give."""
    return F.aggregate(path, start, lambda node, beside: digest(beside["left"], node, beside["right"]))


def proof_digest(path: Column) -> Column:
    """A digest of all siblings on the way up, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda beside: F.concat(beside["left"], beside["right"])), ""), 256)


def _grouped(nodes: DataFrame, tree: Sequence[str], width: int, carried: Sequence[str] = ()) -> DataFrame:
    """Runs of nodes whose intervals lie in the same ``width`` ranks, each as one row with its ``children``.

    A tree of a single node ends there: its row is ``done``, and the node goes up as it is.
    """
    node = F.struct("lo", "hi", "digest", *carried)
    runs = nodes.groupBy(*tree, F.expr(f"lo div {width}L").alias("bucket")).agg(
        F.array_sort(F.collect_list(node)).alias("children")
    )
    first = F.col("children")[0]
    done = (F.col("bucket") == 0) & (F.size("children") == 1)
    return runs.select(
        *tree,
        first["lo"].alias("lo"),
        F.element_at("children", -1)["hi"].alias("hi"),
        done.alias("done"),
        F.when(done, first["digest"]).otherwise(F.sha2(joined(F.col("children")), 256)).alias("digest"),
        "children",
    )


def _levels(leaves: DataFrame, tree: Sequence[str], fanout: int, carried: Sequence[str] = ()) -> list[DataFrame]:
    """The trees' runs level by level, written, until every tree is down to one node."""
    width, levels = fanout, [written(_grouped(leaves, tree, fanout, carried), "runs")]
    while not (rest := levels[-1].where("not done")).isEmpty():
        width *= fanout
        levels.append(written(_grouped(rest, tree, width), "runs"))
    return levels


def _attached(levels: list[DataFrame], tree: Sequence[str], ends: DataFrame, fanout: int) -> DataFrame:
    """The lowest level's runs with ``path`` and the other columns of ``ends``, which has one row for each tree.

    From the top down, each node finds its parent among the runs of the next level: the same bucket of ranks, and an
    interval that contains its own. What is beside it there goes before the parent's path.
    """
    above = None
    facts = [c for c in ends.columns if c not in tree]
    for depth in range(len(levels) - 1, -1, -1):
        runs = levels[depth]
        renamed = ends.select(*[F.col(c).alias(f"_e_{c}") for c in tree], *facts)
        finished = runs.where("done")
        attached = finished.join(renamed, null_safe(finished, renamed, [(c, f"_e_{c}") for c in tree]))
        attached = attached.select(*runs.columns, *facts)
        if above is not None:
            width = fanout ** (depth + 2)
            parent = above.select(*[F.col(c).alias(f"_p_{c}") for c in above.columns])
            parent = parent.withColumn("_p_bucket", F.expr(f"_p_lo div {width}L"))
            child = runs.where("not done").withColumn("bucket", F.expr(f"lo div {width}L"))
            inside = (parent["_p_lo"] <= child["lo"]) & (child["hi"] <= parent["_p_hi"])
            same = null_safe(child, parent, [(c, f"_p_{c}") for c in tree]) & (child["bucket"] == parent["_p_bucket"])
            found = child.join(parent, same & inside)
            beside = siblings(F.col("_p_children"), F.col("lo"), F.col("hi"))
            own = F.when(F.col("_p_done"), F.col("_p_path")).otherwise(F.concat(F.array(beside), F.col("_p_path")))
            more = [own.alias("path") if c == "path" else F.col(f"_p_{c}").alias(c) for c in facts]
            attached = attached.unionByName(found.select(*runs.columns, *more))
        # The lowest level is only read once and keeps streaming into the leaves.
        above = written(attached, "paths") if depth else attached
    return above


def _leaves(runs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per leaf with its own path, from the lowest runs with theirs."""
    each = runs.select(*keep, "done", "path", "children", F.explode("children").alias("node"))
    beside = siblings(F.col("children"), F.col("node")["lo"], F.col("node")["hi"])
    path = F.when(F.col("done"), F.col("path")).otherwise(F.concat(F.array(beside), F.col("path")))
    return each.select(*keep, "node", path.alias("path"))


def manifest(rows: DataFrame, source: str, order: str, leaf: str, carried: Sequence[str] = (), fanout: int = 16) -> DataFrame:
    """Adds ``subroot``, ``root`` and ``path`` to rows with a digest ``leaf``; keeps ``order`` and the carried columns.

    Per source, rows ascend by ``order``, ties by leaf and carried columns, nulls first; ``fanout`` consecutive nodes
    give the node above until one is left, and the sources' last nodes, in the order of sources (null first, as a
    source of its own), do the same. ``path`` lists what stands left and right of the row's ancestors, from the leaf
    up; a run of one has empty neighbours, and a tree of one leaf adds nothing. Repeated rows are leaves of their own.
    No rows give no rows and no root.

    A source of any size is numbered by ranges; no group is larger than ``fanout``. Paths are attached to the nodes
    above the leaves, whose number is the rows' divided by ``fanout`` squared, and reach the rows within the join.
    """
    mine = rows.select(
        F.col(source).alias("source"), F.col(order).alias("_order"), F.col(leaf).alias("digest"),
        *[F.col(c).alias(f"_c_{c}") for c in carried],
    )
    ranked = ordered(written(mine, "leaves"), ["source"], ["_order"], "lo").withColumn("hi", F.col("lo") + 1)
    held = ["_order", *[f"_c_{c}" for c in carried]]
    trees = _levels(ranked, ["source"], fanout, held)
    ends = None
    for level in trees:
        part = level.where("done").select("source", "digest")
        ends = part if ends is None else ends.unionByName(part)
    ends = ordered(ends, [], ["source"], "lo").withColumn("hi", F.col("lo") + 1)
    # The tree over the sources: one tree, so its key is a constant.
    ends = ends.withColumn("tree", F.lit(0))
    top = _levels(ends, ["tree"], fanout, ["source"])
    root = top[-1].select("tree", F.col("digest").alias("root"), F.array().cast(PATH).alias("path"))
    lowest = _leaves(_attached(top, ["tree"], root, fanout), ["root"])
    facts = lowest.select(
        F.col("node")["source"].alias("source"), F.col("node")["digest"].alias("subroot"), "root", "path"
    )
    runs = _attached(trees, ["source"], written(facts, "ends"), fanout)
    each = _leaves(runs, ["source", "subroot", "root"])
    return each.select(
        F.col("source").alias(source),
        F.col("node")["_order"].alias(order),
        F.col("node")["digest"].alias(leaf),
        *[F.col("node")[f"_c_{c}"].alias(c) for c in carried],
        "subroot",
        "root",
        "path",
    )


PATH = "array<struct<left:string,right:string>>"


def document_leaf(text: Column) -> Column:
    fields = (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    return digest(*[encoded(f) for f in fields])


def verify_documents(docs: DataFrame, one_in: int = 5) -> DataFrame:
    """The manifest of a table of documents, and whether each document, some of them tampered with, still verifies.

    Where ``one_in`` divides the checksum of the doc_id, the text's A-Z are lower-cased before the leaf is folded with
    the original siblings; a document without such letters, or without text, stays as it is and verifies. A null
    doc_id is never tampered with. Other columns than those of the leaf are left out.
    """
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % one_in == 0
    tampered = F.when(chosen, document_leaf(F.translate("text", UPPER, LOWER)))
    leaves = docs.select("doc_id", "source", document_leaf(F.col("text")).alias("leaf"), tampered.alias("tampered"))
    proven = manifest(leaves, "source", "doc_id", "leaf", ["tampered"])
    start = F.coalesce("tampered", "leaf")
    rows = proven.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
        folded(start, F.col("path")).alias("folded_root"),
    )
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


#: DuckDB SQL of ``verify_documents``: nodes by level, then every leaf folded level by level.
SQL = """
WITH RECURSIVE bytes AS (
  SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM range(256) t(i)
), d AS (
  SELECT doc_id, source, (CASE WHEN source IS NULL THEN '0' ELSE '1' || source END) AS tree,
         concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'),
                coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
         text, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT)),
             lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM documents, bytes
), leaf AS (
  SELECT doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN crc % 5 = 0 THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS tampered,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS rank
  FROM d
), low AS (
  SELECT tree, 0 AS level, rank AS i, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM leaf
  UNION ALL
  SELECT tree, level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 15) // 16)
  FROM low WHERE n > 1 GROUP BY tree, level, i // 16
), sub AS (
  SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM low WHERE n = 1
), top AS (
  SELECT 0 AS level, place AS i, subroot AS h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 15) // 16)
  FROM top WHERE n > 1 GROUP BY level, i // 16
), nodes AS (
  SELECT tree, level, i, h FROM low WHERE n > 1
  UNION ALL
  SELECT NULL, 1000 + level, i, h FROM top WHERE n > 1
), runs AS (
  SELECT tree, level, i // 16 AS run, list(h ORDER BY i) AS hs FROM nodes GROUP BY tree, level, i // 16
), steps AS (
  SELECT l.doc_id, r.level, r.hs, (l.rank // (16 ** r.level)::BIGINT) % 16 AS own
  FROM leaf l JOIN runs r ON r.tree = l.tree AND r.run = l.rank // (16 ** (r.level + 1))::BIGINT
  UNION ALL
  SELECT l.doc_id, r.level, r.hs, (s.place // (16 ** (r.level - 1000))::BIGINT) % 16
  FROM leaf l JOIN sub s USING (tree)
  JOIN runs r ON r.tree IS NULL AND r.run = s.place // (16 ** (r.level - 999))::BIGINT
), beside AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY level) AS step,
         array_to_string(hs[1 : own], '') AS l, array_to_string(hs[own + 2 :], '') AS r
  FROM steps
), fold AS (
  SELECT doc_id, 0::BIGINT AS step, coalesce(tampered, leaf) AS h FROM leaf
  UNION ALL
  SELECT f.doc_id, b.step, sha256(b.l || f.h || b.r) FROM fold f JOIN beside b ON b.doc_id = f.doc_id AND b.step = f.step + 1
), proof AS (
  SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY step)) AS proof FROM beside GROUP BY doc_id
)
SELECT l.doc_id, l.leaf, s.subroot, t.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256, f.h AS folded_root,
       f.h = t.h AS verified
FROM leaf l JOIN sub s USING (tree) JOIN top t ON t.n = 1 LEFT JOIN proof p USING (doc_id)
JOIN (SELECT doc_id, max_by(h, step) AS h FROM fold GROUP BY doc_id) f USING (doc_id)
"""

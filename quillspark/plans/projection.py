"""The bibliographic domain as a projection of the star schema, once as DataFrames and once as DuckDB views.

Papers are parts, seeds are orders, projects are regions, queues and reports come from documents.  Text columns are
built from keys by the same rule in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Domain:
    """Lazily built tables of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _regions(self) -> DataFrame:
        nations = self.table("nation").join(self.table("region"), F.expr("n_regionkey = r_regionkey")).select("n_nationkey", "r_name")
        return self.table("supplier").join(nations, F.expr("s_nationkey = n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "r_name")

    @property
    def candidates(self) -> DataFrame:
        reverse = F.col("l_returnflag") == "R"
        lines = self.table("lineitem").join(self._regions(), "l_suppkey")
        return lines.groupBy(
            F.col("l_partkey").cast("string").alias("doi"),
            F.when(reverse, "reverse").otherwise("forward").alias("source_type"),
            F.col("l_orderkey").cast("string").alias("source_seed_doi"),
            F.col("r_name").alias("source_project"),
        ).agg(F.max(F.when(reverse, 0).otherwise(F.col("l_quantity").cast("int"))).alias("citing_cited_by"))

    @property
    def metadata(self) -> DataFrame:
        return self.table("part").filter("p_partkey % 10 <> 7").select(
            F.col("p_partkey").cast("string").alias("doi"),
            (F.col("p_size") + 1970).alias("year"),
            F.col("p_brand").alias("lastname"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("venue"),
            F.concat_ws("; ", "p_brand", "p_type").alias("authors"),
            F.when(F.expr("p_partkey % 3 <> 0"), F.col("p_name")).alias("abstract"),
        )

    @property
    def locations(self) -> DataFrame:
        held = self.table("lineitem").filter("l_shipdate < timestamp_ntz'1995-02-01 00:00:00'").join(self._regions(), "l_suppkey").select("l_partkey", F.col("r_name").alias("project")).distinct()
        return held.select(
            F.col("l_partkey").cast("string").alias("doi"),
            "project",
            F.concat(F.lit("paper_"), F.col("l_partkey").cast("string"), F.lit(".pdf")).alias("pdf_filename"),
            F.expr("l_partkey % 2 = 0").alias("has_pdf"),
            F.expr("l_partkey % 3 = 0").alias("has_sidecar"),
            F.expr("l_partkey % 5 <> 0").alias("has_ris"),
            F.expr("cast(l_partkey * 37 % 5000 as int)").alias("sidecar_text_len"),
        )

    @property
    def recommendations(self) -> DataFrame:
        """Each order's parts recommend one another's neighbour; the rank is the line's number."""
        return self.table("lineitem").groupBy(F.col("l_orderkey").cast("string").alias("_o"), F.col("l_linenumber").alias("rank")).agg(F.max("l_partkey").alias("p")).select((F.col("_o").cast("long") % 2000).cast("string").alias("seed_doi"), F.col("p").cast("string").alias("recommended_doi"), "rank").groupBy("seed_doi", "recommended_doi").agg(F.min("rank").alias("rank"))

    @property
    def queue(self) -> DataFrame:
        """One request for each document; DOIs in mixed forms, some broken."""
        i = F.col("doc_id")
        return self.table("documents").select(
            "doc_id",
            F.expr("concat(case when doc_id % 4 = 0 then 'https://doi.org/' when doc_id % 4 = 1 then 'doi:' when doc_id % 4 = 2 then ' ' else '' end, '10.', 1000 + doc_id % 9000, '/', case when doc_id % 7 = 0 then 'Cphy' else concat(upper(lang), '.', doc_id) end, case when doc_id % 5 = 0 then ').' else '' end)").alias("doi"),
            F.expr("concat('Effects of the ', source, ' on <i>heat</i> and ', lang, '-training in ', doc_id % 100, ' women: a Review')").alias("title"),
            F.expr("case when doc_id % 6 = 0 then concat('J. M', upper(lang), 'son; K Jones') when doc_id % 6 = 1 then concat('Müller-', source, ' AB; Roussos P') when doc_id % 6 = 2 then concat('Ørsted ', source, ', Jay O, et al.') when doc_id % 6 = 3 then 'Smith, John; Doe, Jane' when doc_id % 6 = 4 then '' else concat('Périard JD ', lang) end").alias("authors"),
            F.expr("case when doc_id % 11 = 0 then 'in press' when doc_id % 11 = 1 then '2020a' when doc_id % 11 = 2 then '1,998' when doc_id % 11 = 3 then '' else cast(1950 + doc_id % 80 as string) end").alias("year"),
            F.expr("case when doc_id % 3 = 0 then '' else concat('literature/', source) end").alias("destination"),
            F.col("source").alias("project"),
            F.expr("cast(n_chars % 500 as string)").alias("citation_count"),
            (i % 3 == 0).alias("is_oa"),
        )

    def report(self, stage: int) -> DataFrame:
        """A stage's report over the queue."""
        kind = {1: "doc_id % 3 = 0", 2: "doc_id % 5 = 0", 3: "doc_id % 7 = 1"}[stage]
        return self.table("documents").select(
            F.expr("concat('10.', 1000 + doc_id % 9000, '/X.', doc_id)").alias("doi"),
            F.expr(f"case when {kind} then 'True' else 'False' end").alias("downloaded"),
            F.expr("case when doc_id % 13 = 0 then 'ALREADY_EXISTS' when doc_id % 17 = 0 then 'SKIP_EXISTS' else 'CLOSED' end").alias("status"),
        )


VIEWS = """WITH regions AS (SELECT s_suppkey AS l_suppkey, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
candidates AS (SELECT CAST(l_partkey AS VARCHAR) AS doi, CASE WHEN l_returnflag = 'R' THEN 'reverse' ELSE 'forward' END AS source_type, CAST(l_orderkey AS VARCHAR) AS source_seed_doi, r_name AS source_project,
  max(CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(trunc(l_quantity) AS INTEGER) END) AS citing_cited_by FROM lineitem JOIN regions USING (l_suppkey) GROUP BY 1, 2, 3, 4),
paper_metadata AS (SELECT CAST(p_partkey AS VARCHAR) AS doi, 1970 + p_size AS year, p_brand AS lastname, p_name AS title, p_type AS venue, p_brand || '; ' || p_type AS authors, CASE WHEN p_partkey % 3 <> 0 THEN p_name END AS abstract FROM part WHERE p_partkey % 10 <> 7),
paper_locations AS (SELECT CAST(k AS VARCHAR) AS doi, project, 'paper_' || k || '.pdf' AS pdf_filename, k % 2 = 0 AS has_pdf, k % 3 = 0 AS has_sidecar, k % 5 <> 0 AS has_ris, CAST(k * 37 % 5000 AS INTEGER) AS sidecar_text_len
  FROM (SELECT DISTINCT l_partkey AS k, r_name AS project FROM lineitem JOIN regions USING (l_suppkey) WHERE l_shipdate < TIMESTAMP '1995-02-01')),
recommendations AS (SELECT CAST(o % 2000 AS VARCHAR) AS seed_doi, CAST(p AS VARCHAR) AS recommended_doi, min(rank) AS rank FROM (SELECT l_orderkey AS o, l_linenumber AS rank, max(l_partkey) AS p FROM lineitem GROUP BY 1, 2) GROUP BY 1, 2),
top_candidates AS (SELECT c.doi, year, title, abstract, count(DISTINCT source_seed_doi) AS n_seeds, max(citing_cited_by) AS max_cited_by, string_agg(DISTINCT source_type, ',' ORDER BY source_type) AS source_types, string_agg(DISTINCT source_project, ',' ORDER BY source_project) AS via_projects
  FROM candidates c LEFT JOIN paper_metadata m ON c.doi = m.doi WHERE NOT EXISTS (SELECT 1 FROM paper_locations l WHERE l.doi = c.doi) GROUP BY 1, 2, 3, 4),
all_edges AS (SELECT CASE WHEN source_type = 'forward' THEN doi ELSE source_seed_doi END AS citing_doi, CASE WHEN source_type = 'forward' THEN source_seed_doi ELSE doi END AS cited_doi, max(source_type) AS source_pipeline, source_project FROM candidates GROUP BY 1, 2, 4),
queue AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'https://doi.org/' WHEN 1 THEN 'doi:' WHEN 2 THEN ' ' ELSE '' END || '10.' || (1000 + doc_id % 9000) || '/' || CASE WHEN doc_id % 7 = 0 THEN 'Cphy' ELSE upper(lang) || '.' || doc_id END || CASE WHEN doc_id % 5 = 0 THEN ').' ELSE '' END AS doi,
  'Effects of the ' || source || ' on <i>heat</i> and ' || lang || '-training in ' || (doc_id % 100) || ' women: a Review' AS title,
  CASE doc_id % 6 WHEN 0 THEN 'J. M' || upper(lang) || 'son; K Jones' WHEN 1 THEN 'Müller-' || source || ' AB; Roussos P' WHEN 2 THEN 'Ørsted ' || source || ', Jay O, et al.' WHEN 3 THEN 'Smith, John; Doe, Jane' WHEN 4 THEN '' ELSE 'Périard JD ' || lang END AS authors,
  CASE doc_id % 11 WHEN 0 THEN 'in press' WHEN 1 THEN '2020a' WHEN 2 THEN '1,998' WHEN 3 THEN '' ELSE CAST(1950 + doc_id % 80 AS VARCHAR) END AS year,
  CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'literature/' || source END AS destination, source AS project, CAST(n_chars % 500 AS VARCHAR) AS citation_count, doc_id % 3 = 0 AS is_oa FROM documents),
report AS (SELECT doc_id, '10.' || (1000 + doc_id % 9000) || '/X.' || doc_id AS doi, doc_id % 3 = 0 AS d1, doc_id % 5 = 0 AS d2, doc_id % 7 = 1 AS d3, doc_id % 13 = 0 OR doc_id % 17 = 0 AS there FROM documents)
"""

"""SQL equivalents of the queries, for a row-by-row comparison in DuckDB.

Each query is the list of named parts it needs, in order, and a final SELECT.
"""

from __future__ import annotations

from cohortscope.domain import ALTERNATIVE_PATTERNS, DOSE_CHANGE_PATTERNS
from cohortscope.plans.driver_tables import EVIDENCE, PHENOTYPES, PHRASES, STRENGTHS, STUDY


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick(choices, index: str) -> str:
    return f"([{', '.join(text(c) for c in choices)}])[{index} + 1]"


def pattern(patterns) -> str:
    return text("|".join(f"(?:{p})" for p in patterns))


def wilson(k: str, n: str) -> tuple[str, str]:
    center = f"(({k} + 1.9208::DOUBLE) / ({n} + 3.8416::DOUBLE))"
    half = (
        f"(1.96::DOUBLE / ({n} + 3.8416::DOUBLE)"
        f" * sqrt({k}::DOUBLE * ({n} - {k}) / {n} + 0.9604::DOUBLE))"
    )
    return (
        f"round_even(greatest(0.0::DOUBLE, {center} - {half}), 6)",
        f"round_even(least(1.0::DOUBLE, {center} + {half}), 6)",
    )


REGION_ROWS = ", ".join(
    f"({i}, {text(r.gene)}, {text(r.chromosome)}, {r.start}, {r.end})"
    for i, r in enumerate(STUDY.regions)
)
KEY_ROWS = ", ".join(
    f"({text(gene)}, {text(variant)}, {len(ids)})"
    for gene, ids in STUDY.key_variants.items()
    for variant in ids
)
CURATED_ROWS = ", ".join(
    "(" + ", ".join(str(v).upper() if isinstance(v, bool) else text(v) for v in row) + ")"
    for row in STUDY.curated
)
SCOPE_ROWS = ", ".join(
    f"({text(symbol)}, {str(in_scope).upper()}, {text(reason)})"
    for symbol, in_scope, reason in STUDY.scope
)
COHORT_ROWS = ", ".join(
    f"({text(code)}, {text(name)}, {text(region)})"
    for code, (name, region) in STUDY.cohorts.items()
)
TARGETS = ", ".join(text(c) for c in STUDY.target_cohorts)
LOWER_K, UPPER_K = wilson("allele_count", "total_alleles")
LOWER_P, UPPER_P = wilson("individual_count", "population_total")
STRENGTH = "trim(lower(coalesce(classification_strength, '')))"

PARTS = {
    "regions": f"regions(ord, gene, chrom, lo, hi) AS (VALUES {REGION_ROWS})",
    "key_variants": f"key_variants(gene, variant, n_key) AS (VALUES {KEY_ROWS})",
    "curated": (
        "curated(gene_symbol, drug_name, phenotype, recommendation_text, "
        "classification_strength, requires_dose_change, requires_alternative, "
        f"cpic_release_version) AS (VALUES {CURATED_ROWS})"
    ),
    "scope": f"scope(gene_symbol, is_in_scope, scope_rationale) AS (VALUES {SCOPE_ROWS})",
    "cohort_names": f"cohort_names(code, name, area) AS (VALUES {COHORT_ROWS})",
    "sites": """sites AS (
        SELECT *, 'chr' || (l_partkey % 5 + 1) AS chromosome,
               (l_partkey % 40) * 25 AS position,
               CAST(l_quantity AS INTEGER) % 3 AS allele_dosage
        FROM lineitem)""",
    "located": """located AS (
        SELECT s.*, (SELECT arg_max(gene, ord) FROM regions
                     WHERE chrom = s.chromosome AND s.position BETWEEN lo AND hi) AS gene_symbol
        FROM sites s)""",
    "samples": """samples AS (
        SELECT 'S' || c_custkey AS sample_id, n_name AS population_code,
               r_name AS superpopulation
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey)""",
    "variants": """variants AS (
        SELECT sample_id, variant_id, gene_symbol, chromosome, position, reference_allele,
               alternate_allele, genotype, allele_dosage, population_code, superpopulation
        FROM (
            SELECT 'S' || o_custkey AS sample_id, chromosome || ':' || position AS variant_id,
                   gene_symbol, chromosome, position, 'A' AS reference_allele,
                   'G' AS alternate_allele, allele_dosage,
                   CASE WHEN l_suppkey % 10 = 0 AND allele_dosage < 2
                        THEN CAST(allele_dosage AS VARCHAR)
                        ELSE (['0|0', '0|1', '1|1'])[allele_dosage + 1] END AS genotype,
                   row_number() OVER (
                       PARTITION BY o_custkey, chromosome, position
                       ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
                                l_extendedprice) AS copy
            FROM located JOIN orders ON l_orderkey = o_orderkey
            WHERE gene_symbol IS NOT NULL)
        JOIN samples USING (sample_id)
        WHERE copy = 1 AND population_code IN (""" + TARGETS + "))",
    "populations": """populations AS (
        SELECT population_code, coalesce(name, population_code) AS population_name,
               superpopulation, coalesce(area, 'Unknown') AS region, sample_size
        FROM (SELECT population_code, superpopulation, count(*) AS sample_size
              FROM samples WHERE population_code IN (""" + TARGETS + """) GROUP BY 1, 2)
        LEFT JOIN cohort_names ON code = population_code),
    sized AS (SELECT * FROM populations WHERE population_code <> 'NATION_5')""",
    "guidance": f"""guidance AS (
        SELECT 'GL' || p_partkey AS guideline_id, 'G' || (p_partkey % 5 + 1) AS gene_symbol,
               CASE WHEN p_partkey % 2 = 1 THEN '  ' || upper(p_name) || ' ' ELSE p_name END
                   AS drug_name,
               {pick(PHENOTYPES, 'p_size % 4')} AS phenotype,
               {pick(PHRASES, '(p_partkey + p_size) % 8')} AS recommendation_text,
               {pick(STRENGTHS, 'p_partkey % 7')} AS classification_strength,
               'v' || (p_size % 3) AS cpic_release_version
        FROM part)""",
    "flagged": f"""flagged AS (
        SELECT *, {STRENGTH} NOT IN ('', 'no recommendation')
                 AND regexp_matches(lower(recommendation_text), {pattern(DOSE_CHANGE_PATTERNS)})
                 AS requires_dose_change,
               {STRENGTH} NOT IN ('', 'no recommendation')
                 AND regexp_matches(lower(recommendation_text), {pattern(ALTERNATIVE_PATTERNS)})
                 AS requires_alternative
        FROM guidance)""",
    "recommendations": """source_rows AS (
        SELECT gene_symbol, lower(trim(drug_name)) AS drug_name, phenotype,
               recommendation_text, classification_strength, requires_dose_change,
               requires_alternative, cpic_release_version
        FROM flagged WHERE gene_symbol IN ('G1', 'G2', 'G3', 'G4')
        QUALIFY row_number() OVER (
            PARTITION BY gene_symbol, lower(trim(drug_name)), phenotype
            ORDER BY guideline_id, recommendation_text) = 1),
    recommendations AS (
        SELECT * FROM source_rows r
        WHERE NOT EXISTS (SELECT 1 FROM curated c
                          WHERE c.gene_symbol = r.gene_symbol AND c.drug_name = r.drug_name
                            AND c.phenotype = r.phenotype)
        UNION ALL SELECT * FROM curated)""",
    "clinical": f"""annotations AS (
        SELECT 'CA' || p_partkey AS annotation_id,
               'chr' || (p_partkey % 5 + 1) || ':' || ((p_partkey % 40) * 25) AS variant_rsid,
               'G' || (p_partkey % 5 + 1) AS gene_symbol,
               unnest(string_split_regex(
                   CASE WHEN p_size <> 1 THEN p_name || '; ' || p_type || ' , ' || p_brand
                        ELSE '' END, '[,;]')) AS entry,
               unnest(range(1, 1 + len(string_split_regex(
                   CASE WHEN p_size <> 1 THEN p_name || '; ' || p_type || ' , ' || p_brand
                        ELSE '' END, '[,;]')))) AS entry_no,
               CASE WHEN p_size % 2 = 0 THEN 'Dosage' ELSE '' END AS phenotype_category,
               CASE WHEN p_partkey % 40 < 20 THEN {pick(EVIDENCE, 'p_size % 6')} ELSE '3' END
                   AS evidence_level,
               substring(CASE WHEN p_size % 5 <> 0
                              THEN repeat(p_name || ' ' || p_type || '. ', 30) ELSE '' END, 1, 500)
                   AS annotation_summary
        FROM part),
    clinical AS (
        SELECT variant_rsid, gene_symbol, lower(trim(entry)) AS drug_name, phenotype_category,
               evidence_level, coalesce(evidence_level IN ('1A', '1B'), FALSE) AS is_actionable,
               annotation_summary
        FROM annotations WHERE gene_symbol IN ('G1', 'G2', 'G3', 'G4')
        QUALIFY row_number() OVER (
            PARTITION BY variant_rsid, gene_symbol, lower(trim(entry))
            ORDER BY annotation_id, entry_no) = 1)""",
    "counts": """counts AS (
        SELECT variant_id, gene_symbol, chromosome, position, reference_allele,
               alternate_allele, population_code, superpopulation,
               CAST(sum(allele_dosage) AS BIGINT) AS allele_count,
               count(DISTINCT sample_id) * 2 AS total_alleles
        FROM variants GROUP BY ALL)""",
    "hemizygous_counts": r"""counts AS (
        SELECT variant_id, gene_symbol, chromosome, position, reference_allele,
               alternate_allele, population_code, superpopulation,
               CAST(sum(allele_dosage) AS BIGINT) AS allele_count,
               CAST(sum(len(string_split_regex(genotype, '[|/]'))) AS BIGINT) AS total_alleles
        FROM variants GROUP BY ALL)""",
    "rated": f"""rated AS (
        SELECT *, round_even(allele_count / total_alleles, 6) AS allele_frequency,
               {LOWER_K} AS ci_lower_wilson, {UPPER_K} AS ci_upper_wilson
        FROM counts)""",
    "frequencies": """frequencies AS (
        SELECT r.*, round_even(r.allele_frequency - b.allele_frequency, 6) AS delta_vs_ceu,
               r.variant_id IN (SELECT variant_rsid FROM clinical WHERE is_actionable)
                   AS is_actionable,
               DATE '2025-01-01' AS snapshot_date
        FROM rated r
        LEFT JOIN (SELECT variant_id, allele_frequency FROM rated
                   WHERE population_code = 'NATION_0') b USING (variant_id))""",
    "dosages": """dosages AS (
        SELECT sample_id, population_code, superpopulation, gene_symbol,
               CAST(sum(allele_dosage) AS BIGINT) AS total_dosage, max(n_key) AS n_key
        FROM variants JOIN key_variants ON gene = gene_symbol AND variant = variant_id
        GROUP BY sample_id, population_code, superpopulation, gene_symbol)""",
    "people": """people AS (
        SELECT *, CASE WHEN copies < 0 THEN 'Indeterminate'
                       WHEN gene_symbol = 'G2' AND copies = 0 THEN 'Normal'
                       WHEN gene_symbol = 'G2' THEN 'Deficient'
                       WHEN copies = 0 THEN 'Normal' WHEN copies = 1 THEN 'Intermediate'
                       ELSE 'Poor' END AS phenotype_category
        FROM (SELECT *, CASE WHEN gene_symbol = 'G4' THEN 2 * n_key - total_dosage
                             ELSE total_dosage END AS copies FROM dosages))""",
    "phenotypes": f"""observed AS (
        SELECT *, individual_count / population_total AS share, 'observed' AS data_source
        FROM (
            SELECT gene_symbol, population_code, p.superpopulation, phenotype_category,
                   count(*) AS individual_count,
                   coalesce(sample_size, CAST(sum(count(*)) OVER (
                       PARTITION BY gene_symbol, population_code) AS BIGINT)) AS population_total
            FROM people p LEFT JOIN sized USING (population_code)
            GROUP BY gene_symbol, population_code, p.superpopulation, phenotype_category,
                     sample_size)),
    published AS (
        SELECT 'G3' AS gene_symbol, population_code, superpopulation, category, share,
               CAST(round_even(share * sample_size, 0) AS BIGINT) AS individual_count,
               sample_size AS population_total
        FROM sized,
             (VALUES ('Normal', (1 - 0.031::DOUBLE) * (1 - 0.031::DOUBLE)),
                     ('Intermediate', 2 * 0.031::DOUBLE * (1 - 0.031::DOUBLE)),
                     ('Poor', 0.031::DOUBLE * 0.031::DOUBLE)) AS t(category, share)
        WHERE population_code = 'NATION_7'
          AND EXISTS (SELECT 1 FROM observed WHERE gene_symbol = 'G3')),
    phenotypes AS (
        SELECT gene_symbol, population_code, superpopulation, phenotype_category,
               individual_count, population_total,
               round_even(share * 100, 2) AS phenotype_percentage,
               {LOWER_P} AS ci_lower_wilson, {UPPER_P} AS ci_upper_wilson, data_source,
               DATE '2025-01-01' AS snapshot_date
        FROM (
            SELECT * FROM observed
            WHERE NOT (gene_symbol = 'G3' AND population_code IN (
                SELECT population_code FROM published))
            UNION ALL
            SELECT gene_symbol, population_code, superpopulation, category, individual_count,
                   population_total, share, 'literature'
            FROM published WHERE individual_count > 0))""",
    "summed": """summed AS (
        SELECT drug_name, gene_symbol, population_code, population_total,
               classification_strength,
               CAST(sum(individual_count) AS BIGINT) AS individuals_requiring_change,
               round_even(sum(individual_count) / population_total * 100, 2)
                   AS percentage_requiring_change
        FROM phenotypes JOIN recommendations USING (gene_symbol)
        WHERE phenotype = phenotype_category AND (requires_dose_change OR requires_alternative)
          AND classification_strength IS NOT NULL
        GROUP BY drug_name, gene_symbol, population_code, population_total,
                 classification_strength)""",
    "impact": """impact AS (
        SELECT s.*, coalesce(b.percentage_requiring_change, 0.0) AS baseline_ceu_percentage,
               round_even(s.percentage_requiring_change
                          - coalesce(b.percentage_requiring_change, 0.0), 2)
                   AS delta_vs_baseline,
               DATE '2025-01-01' AS snapshot_date
        FROM summed s
        LEFT JOIN summed b ON b.population_code = 'NATION_0' AND b.drug_name = s.drug_name
            AND b.gene_symbol = s.gene_symbol)""",
    "strict_impact": """strict_impact AS (
        SELECT s.*, coalesce(b.percentage_requiring_change, 0.0) AS baseline_ceu_percentage,
               round_even(s.percentage_requiring_change
                          - coalesce(b.percentage_requiring_change, 0.0), 2)
                   AS delta_vs_baseline,
               DATE '2025-01-01' AS snapshot_date
        FROM summed s
        LEFT JOIN summed b ON b.population_code = 'NATION_0' AND b.drug_name = s.drug_name
            AND b.gene_symbol = s.gene_symbol
            AND b.classification_strength = s.classification_strength)""",
    "joint": """joint_rows AS (
        SELECT population_code, count(*) AS seen,
               count(*) FILTER (WHERE (a, b) IN (
                   ('Intermediate', 'Deficient'), ('Poor', 'Normal'), ('Poor', 'Deficient')))
                   AS affected
        FROM (
            SELECT x.population_code, x.phenotype_category AS a, y.phenotype_category AS b
            FROM people x JOIN people y USING (sample_id, population_code)
            WHERE x.gene_symbol = 'G1' AND y.gene_symbol = 'G2')
        GROUP BY population_code),
    joint_rated AS (
        SELECT population_code, coalesce(sample_size, seen) AS population_total, affected,
               round_even(affected / coalesce(sample_size, seen) * 100, 2) AS pct
        FROM joint_rows LEFT JOIN sized USING (population_code)),
    joint AS (
        SELECT 'joint drug' AS drug_name, 'G1+G2' AS gene_symbol, population_code,
               population_total, 'Strong' AS classification_strength,
               affected AS individuals_requiring_change, pct AS percentage_requiring_change,
               coalesce(base, 0.0) AS baseline_ceu_percentage,
               round_even(pct - coalesce(base, 0.0), 2) AS delta_vs_baseline,
               DATE '2025-01-01' AS snapshot_date
        FROM joint_rated,
             (SELECT max(pct) AS base FROM joint_rated WHERE population_code = 'NATION_0'))""",
    "all_impact": """all_impact AS (
        SELECT * FROM impact UNION ALL BY NAME SELECT * FROM joint)""",
    "ranking": """scored AS (
        SELECT *, abs(delta_vs_baseline)
                  * CASE classification_strength WHEN 'Strong' THEN 1.0::DOUBLE
                        WHEN 'Moderate' THEN 0.7::DOUBLE ELSE 0.3::DOUBLE END
                  * percentage_requiring_change AS score
        FROM all_impact WHERE population_code <> 'NATION_0'),
    placed AS (
        SELECT *, row_number() OVER (
                   PARTITION BY gene_symbol
                   ORDER BY score DESC, drug_name, gene_symbol, population_code,
                            classification_strength, delta_vs_baseline DESC) AS place,
               count(DISTINCT gene_symbol) OVER () AS genes
        FROM scored),
    chosen AS (
        SELECT * FROM placed WHERE place = 1
        UNION ALL
        (SELECT * FROM placed WHERE place > 1
         QUALIFY row_number() OVER (
             ORDER BY score DESC, drug_name, gene_symbol, population_code,
                      classification_strength, delta_vs_baseline DESC) <= 50 - genes)),
    ranking AS (
        SELECT CAST(row_number() OVER (
                   ORDER BY score DESC, drug_name, gene_symbol, population_code,
                            classification_strength, delta_vs_baseline DESC) AS INTEGER)
                   AS rank_position,
               drug_name, gene_symbol, population_code, delta_vs_baseline,
               percentage_requiring_change AS population_affected_pct,
               classification_strength,
               printf('%.1f', abs(delta_vs_baseline)) || 'pp '
                   || CASE WHEN delta_vs_baseline > 0 THEN 'higher' ELSE 'lower' END
                   || ' rate of dose/therapy change vs NATION_0 in ' || population_code
                   || ' (' || drug_name || ' / ' || gene_symbol || ', CPIC '
                   || classification_strength || ')' AS clinical_implication,
               DATE '2025-01-01' AS snapshot_date
        FROM chosen)""",
    "dominant": """dominant AS (
        SELECT gene_symbol, population_code, phenotype_category AS dominant_category
        FROM phenotypes
        QUALIFY row_number() OVER (PARTITION BY gene_symbol, population_code
                                   ORDER BY phenotype_percentage DESC, phenotype_category) = 1)""",
    "means": """means AS (
        SELECT gene_symbol, population_code,
               CAST(sum(CAST(allele_frequency AS DECIMAL(20, 6))) AS DOUBLE) / count(*)
                   AS mean_frequency
        FROM frequencies GROUP BY gene_symbol, population_code)""",
    "gene_rows": """gene_rows AS (
        SELECT 'G' || (p_partkey % 4 * 2 + 1) AS gene_symbol, 'E' || p_partkey AS ensembl_id,
               CASE WHEN p_size % 2 = 0 THEN CAST(p_partkey AS VARCHAR) END AS ncbi_gene_id,
               'chr9' AS chromosome,
               CASE WHEN p_size % 4 <> 0 THEN CAST(p_size AS BIGINT) END AS chromosomal_start,
               CASE WHEN p_size % 5 <> 0 THEN CAST(p_size + p_partkey AS BIGINT) END
                   AS chromosomal_end
        FROM part)""",
}

FACTS = ["regions", "sites", "located", "samples", "variants"]
CLINICAL = ["clinical"]
FREQUENCIES = [*FACTS, *CLINICAL, "counts", "rated", "frequencies"]
COHORTS = ["cohort_names", "samples", "populations"]
PEOPLE = [*FACTS, "key_variants", "dosages", "people"]
PHENOTYPE = [*PEOPLE, "cohort_names", "populations", "phenotypes"]
RECOMMENDED = ["curated", "guidance", "flagged", "recommendations"]
IMPACT = [*PHENOTYPE, *RECOMMENDED, "summed", "impact"]
JOINT = [*PEOPLE, "cohort_names", "populations", "joint"]
RANKED = [*IMPACT, "joint", "all_impact", "ranking"]

FREQUENCY_COLUMNS = """variant_id, gene_symbol, chromosome, position, reference_allele,
    alternate_allele, population_code, superpopulation, allele_count, total_alleles,
    allele_frequency, ci_lower_wilson, ci_upper_wilson, delta_vs_ceu, is_actionable,
    snapshot_date"""
IMPACT_COLUMNS = """drug_name, gene_symbol, population_code, population_total,
    individuals_requiring_change, percentage_requiring_change, baseline_ceu_percentage,
    delta_vs_baseline, classification_strength, snapshot_date"""


def sql(parts: list[str], select: str) -> str:
    chosen = list(dict.fromkeys(parts))
    return (f"WITH {', '.join(PARTS[p] for p in chosen)} " if chosen else "") + select


def null_count_select(table: str, source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, "
        f"count(*) FILTER (WHERE {value} IS NULL) AS null_count FROM {source}"
        for name, value in columns.items()
    )


ORACLE_SQL: dict[str, str] = {
    "allele_frequencies": sql(FREQUENCIES, f"SELECT {FREQUENCY_COLUMNS} FROM frequencies"),
    "gene_assignment": sql(
        ["regions", "sites", "located"],
        """SELECT chromosome, position, gene_symbol, count(*) AS line_count
           FROM located GROUP BY chromosome, position, gene_symbol""",
    ),
    "silver_variants": sql(FACTS, "SELECT * FROM variants"),
    "populations": sql(COHORTS, "SELECT * FROM populations"),
    "individual_dosage": sql(
        PEOPLE,
        """SELECT sample_id, population_code, superpopulation, gene_symbol, total_dosage,
                  copies AS nonfunctional_copies FROM people""",
    ),
    "phenotype_distribution": sql(PHENOTYPE, "SELECT * FROM phenotypes"),
    "literature_correction": sql(
        PHENOTYPE, "SELECT * FROM phenotypes WHERE data_source = 'literature'"
    ),
    "recommendation_flags": sql(
        ["guidance", "flagged"],
        "SELECT guideline_id, requires_dose_change, requires_alternative FROM flagged",
    ),
    "drug_recommendations": sql(RECOMMENDED, "SELECT * FROM recommendations"),
    "curated_override": sql(
        ["curated", "guidance", "flagged"],
        """, normal AS (
               SELECT gene_symbol, lower(trim(drug_name)) AS drug_name, phenotype,
                      recommendation_text, classification_strength, requires_dose_change,
                      requires_alternative, cpic_release_version FROM flagged)
           SELECT * FROM normal r WHERE NOT EXISTS (
               SELECT 1 FROM curated c WHERE c.gene_symbol = r.gene_symbol
                   AND c.drug_name = r.drug_name AND c.phenotype = r.phenotype)
           UNION ALL BY NAME SELECT * FROM curated""",
    ),
    "drug_impact": sql(IMPACT, f"SELECT {IMPACT_COLUMNS} FROM impact"),
    "drug_impact_strict": sql(
        [*IMPACT, "strict_impact"], f"SELECT {IMPACT_COLUMNS} FROM strict_impact"
    ),
    "joint_impact": sql(JOINT, f"SELECT {IMPACT_COLUMNS} FROM joint"),
    "all_impact": sql(
        [*IMPACT, "joint", "all_impact"], f"SELECT {IMPACT_COLUMNS} FROM all_impact"
    ),
    "actionability_ranking": sql(RANKED, "SELECT * FROM ranking"),
    "clinical_variants": sql(CLINICAL, "SELECT * FROM clinical"),
    "gene_scope_table": sql(
        ["scope", "regions", "gene_rows"],
        """SELECT gene_symbol, ensembl_id, ncbi_gene_id, chromosome, chromosomal_start,
                  chromosomal_end, is_in_scope, scope_rationale
           FROM gene_rows JOIN scope USING (gene_symbol)
           UNION ALL
           SELECT gene_symbol, NULL, NULL, chrom, lo, hi, is_in_scope, scope_rationale
           FROM scope LEFT JOIN regions ON gene = gene_symbol
           WHERE gene_symbol NOT IN (SELECT gene_symbol FROM gene_rows)""",
    ),
    "gene_scope_check": sql(
        ["scope", "gene_rows"],
        """SELECT gene_symbol, count(*) AS rows, scope_rationale,
                  CASE WHEN is_in_scope THEN 'in_scope' WHEN NOT is_in_scope THEN 'excluded'
                       ELSE 'unknown' END AS scope_status
           FROM gene_rows LEFT JOIN scope USING (gene_symbol)
           GROUP BY gene_symbol, scope_rationale, is_in_scope""",
    ),
    "guideline_flatten": """
        WITH guidelines AS (
            SELECT 'GL' || s_suppkey AS guidelineid,
                   CASE WHEN s_suppkey % 4 = 0 THEN ['G1', 'G2'] ELSE ['G1', 'g2'] END AS genes,
                   CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_suppkey % 5 AS VARCHAR) ELSE '' END
                       AS version
            FROM supplier),
        drugs AS (
            SELECT 'D' || p_partkey AS drugid, p_name FROM part WHERE p_size <> 2),
        records AS (
            SELECT event_id, 'GL' || user_id AS guidelineid,
                   'D' || (event_id % 3000) AS drugid, event_type,
                   CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
            FROM events)
        SELECT guidelineid || ':' || event_id AS guideline_id, gene AS gene_symbol,
               coalesce(p_name, drugid) AS drug_name,
               CASE WHEN gene = 'G1' THEN (['Normal', 'Poor', ''])[k % 3 + 1]
                    ELSE 'P' || (k % 4) END AS phenotype,
               CASE WHEN gene = 'G1' AND k % 3 = 0 THEN CAST(k AS VARCHAR) ELSE '' END
                   AS activity_score,
               'text for ' || event_type AS recommendation_text,
               CASE WHEN k % 2 = 0 THEN 'Strong' ELSE '' END AS classification_strength,
               version AS cpic_release_version
        FROM (SELECT *, unnest(genes) AS gene FROM records JOIN guidelines USING (guidelineid))
        LEFT JOIN drugs USING (drugid)""",
    "cross_reference_ids": """
        SELECT p_partkey,
               CASE WHEN p_size <> 3 THEN p_brand || ',' || p_type ELSE '' END
                   AS atc_identifiers,
               CASE WHEN p_size <> 3 THEN p_partkey || ':x' ELSE '' END AS rxnorm_identifiers
        FROM part""",
    "genotype_melt": """
        WITH records AS (
            SELECT vec_id, 'chr' || (label % 5 + 1) AS chromosome, vec_id * 3 AS position,
                   CASE WHEN vec_id % 7 = 0 THEN 'rs' || (vec_id % 50)
                        ELSE 'chr' || (label % 5 + 1) || ':' || (vec_id * 3) END AS variant_id,
                   CASE WHEN vec_id % 3 <> 0 THEN CAST(vec_id % 100 AS DOUBLE) END AS quality,
                   CASE WHEN vec_id % 4 = 1 THEN 'q10;s50' ELSE 'PASS' END AS filter_status,
                   embedding
            FROM embeddings WHERE vec_id % 11 <> 1 AND vec_id % 13 <> 1),
        fetched AS (
            SELECT * FROM records r WHERE EXISTS (
                SELECT 1 FROM (VALUES ('chr1', 0, 299), ('chr2', 50, 699), ('chr3', 0, 799),
                                      ('chr4', 200, 999)) AS g(chrom, lo, hi)
                WHERE chrom = chromosome AND position <= hi + 50
                  AND position + 1 >= greatest(1, lo - 50))),
        calls AS (
            SELECT * EXCLUDE (embedding), unnest(embedding) AS x,
                   unnest(range(0, len(embedding))) AS i
            FROM fetched),
        coded AS (SELECT *, CAST(floor(abs(x) * 100) AS BIGINT) % 6 AS code FROM calls)
        SELECT chromosome, position, variant_id, 'AC' AS reference_allele,
               'G' AS alternate_allele, 'P' || i AS sample_id,
               (['0|0', '0|1', '1|1', './.', '0/1', '1'])[code + 1] AS genotype,
               CAST(([0, 1, 2, 0, 1, 1])[code + 1] AS INTEGER) AS allele_dosage, quality,
               filter_status, CAST(NULL AS VARCHAR) AS info_payload
        FROM coded WHERE code <> 3
        QUALIFY row_number() OVER (
            PARTITION BY variant_id, i ORDER BY chromosome, position, genotype) = 1""",
    "quality_report": sql(
        ["guidance", "samples"],
        " UNION ALL ".join(
            [
                null_count_select(
                    "cpic_guidelines_raw",
                    "guidance",
                    {
                        c: c
                        for c in ("guideline_id", "gene_symbol", "drug_name", "recommendation_text")
                    },
                ),
                null_count_select(
                    "samples_metadata_raw",
                    "samples",
                    {
                        "sample_id": "sample_id",
                        "population_code": "population_code",
                        "superpopulation": "superpopulation",
                        "sex": "NULL",
                    },
                ),
                null_count_select(
                    "pharmgkb_clinical_annotations_raw",
                    "part",
                    {
                        "clinical_annotation_id": "p_partkey",
                        "gene_symbol": "p_partkey",
                        "evidence_level": (
                            "CASE WHEN p_partkey % 40 < 20 THEN "
                            f"{pick(EVIDENCE, 'p_size % 6')} ELSE '3' END"
                        ),
                    },
                ),
            ]
        ),
    ),
    "row_gate": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, "
        f"CAST({least} AS BIGINT) AS min_row_count, count(*) >= {least} AS passed FROM {name}"
        for name, least in (("lineitem", 1000), ("part", 100), ("nation", 1000))
    ),
    "dominant_and_mean": sql(
        [*PHENOTYPE, *FREQUENCIES, "dominant", "means"],
        "SELECT * FROM dominant FULL JOIN means USING (gene_symbol, population_code)",
    ),
    "knowledge_documents": sql(
        [*RANKED, *FREQUENCIES, "dominant", "means"],
        """SELECT 'gold/kb-docs/' || gene_symbol || '/' || population_code || '/'
                      || replace(replace(drug_name, ' ', '_'), '/', '-') || '.txt' AS path,
                  'Gene: ' || gene_symbol || chr(10)
                      || 'Population: ' || population_code || ' (' || population_code || ')'
                      || chr(10) || 'Drug: ' || drug_name || chr(10)
                      || 'Phenotype: ' || coalesce(dominant_category, 'Unknown') || chr(10)
                      || 'Allele frequency: '
                      || printf('%.1f', coalesce(mean_frequency, 0.0) * 100) || '%' || chr(10)
                      || 'Actionability: CPIC ' || classification_strength || chr(10)
                      || 'Clinical implication: ' || clinical_implication || chr(10)
                      AS document
           FROM ranking LEFT JOIN dominant USING (gene_symbol, population_code)
           LEFT JOIN means USING (gene_symbol, population_code)
           QUALIFY row_number() OVER (PARTITION BY path ORDER BY rank_position DESC) = 1""",
    ),
    "export_frequencies": sql(
        FREQUENCIES,
        """SELECT * EXCLUDE (reference_allele, alternate_allele) FROM frequencies
           WHERE variant_id IN ('chr1:0', 'chr1:125', 'chr2:150', 'chr3:300', 'chr4:200')
           ORDER BY gene_symbol, population_code, variant_id""",
    ),
    "export_phenotypes": sql(
        PHENOTYPE,
        """SELECT * EXCLUDE (data_source) FROM phenotypes
           ORDER BY gene_symbol, population_code, phenotype_category""",
    ),
    "export_impact": sql(
        IMPACT, f"SELECT {IMPACT_COLUMNS} FROM impact ORDER BY drug_name, gene_symbol, population_code"
    ),
    "export_ranking": sql(RANKED, "SELECT * FROM ranking ORDER BY rank_position"),
    "document_frequencies": sql(
        FREQUENCIES,
        """SELECT gene_symbol, population_code, variant_id, allele_frequency, snapshot_date
           FROM frequencies ORDER BY gene_symbol, population_code, variant_id""",
    ),
    "document_phenotypes": sql(
        PHENOTYPE,
        """SELECT gene_symbol, population_code, phenotype_category, phenotype_percentage,
                  snapshot_date
           FROM phenotypes ORDER BY gene_symbol, population_code, phenotype_category""",
    ),
    "artifact_frequencies": sql(FREQUENCIES, f"SELECT {FREQUENCY_COLUMNS} FROM frequencies"),
    "artifact_phenotypes": sql(PHENOTYPE, "SELECT * FROM phenotypes"),
    "artifact_impact": sql(
        [*IMPACT, "joint", "all_impact"], f"SELECT {IMPACT_COLUMNS} FROM all_impact"
    ),
    "artifact_ranking": sql(RANKED, "SELECT * FROM ranking"),
    "panel": sql(
        ["samples"],
        """SELECT sample_id, population_code, superpopulation,
                  CASE WHEN superpopulation < 'M' THEN 'male' ELSE 'female' END AS sex,
                  CAST(NULL AS VARCHAR) AS family_id FROM samples""",
    ),
    "header_mapping": f"""
        SELECT 'CA' || p_partkey AS clinical_annotation_id,
               CAST(NULL AS VARCHAR) AS variant_or_haplotype,
               'G' || (p_partkey % 5 + 1) AS gene_symbol,
               CASE WHEN p_size <> 1 THEN p_name || '; ' || p_type || ' , ' || p_brand END
                   AS drug_names,
               CAST(NULL AS VARCHAR) AS phenotype_categories,
               CASE WHEN p_partkey % 5 = 0 THEN 'old ' || level ELSE level END AS evidence_level,
               CAST(NULL AS VARCHAR) AS clinical_annotation_types,
               CAST(NULL AS VARCHAR) AS pediatric, CAST(NULL AS VARCHAR) AS annotation_text,
               CAST(NULL AS VARCHAR) AS url
        FROM (SELECT *, CASE WHEN p_partkey % 40 < 20 THEN {pick(EVIDENCE, 'p_size % 6')}
                             ELSE '3' END AS level FROM part)""",
    "guidance_records": """
        SELECT CAST(event_id AS VARCHAR) AS id, 'GL' || user_id AS guidelineid,
               'D' || (event_id % 3000) AS drugid, CAST(NULL AS VARCHAR) AS drugrecommendation,
               CASE WHEN k % 2 = 0 THEN 'Strong' END AS classification,
               (['Normal', 'Poor', ''])[k % 3 + 1] AS first_phenotype,
               CAST(2 AS INTEGER) AS phenotype_count,
               CASE WHEN k % 3 = 0 THEN CAST(k AS VARCHAR) END AS first_score
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "guidance_shapes": """
        WITH records AS (
            SELECT 'part' || (user_id % 3) AS file, event_id, event_id % 11 AS shape,
                   'GL' || user_id AS guideline, event_type,
                   (['1.0', 'n/a', 'true', '[1,2.5]', NULL])[event_id % 5 + 1] AS score
            FROM events)
        SELECT file, CASE WHEN shape NOT IN (1, 3) THEN CAST(event_id AS VARCHAR) END AS id,
               CASE WHEN shape NOT IN (1, 3) THEN guideline END AS guidelineid,
               CASE WHEN shape NOT IN (1, 3) THEN event_type END AS first_phenotype,
               CASE WHEN shape NOT IN (1, 3) THEN score END AS second_phenotype,
               CASE WHEN shape > 4 THEN score END AS first_score,
               CASE shape WHEN 0 THEN 'activityscore is no map<string,string>: ARRAY'
                          WHEN 1 THEN 'no JSON' WHEN 3 THEN 'no object: BIGINT' END AS problem
        FROM records
        UNION ALL
        SELECT file, '-' || (event_id + 1), NULL, NULL, NULL, NULL, NULL FROM records WHERE shape = 2""",
    "frequencies_from_repeated_calls": sql(
        FREQUENCIES, f"SELECT {FREQUENCY_COLUMNS} FROM frequencies"
    ),
    "frequencies_from_dates": sql(FREQUENCIES, f"SELECT {FREQUENCY_COLUMNS} FROM frequencies"),
    "gene_assignment_by_bins": """
        WITH regions AS (
            SELECT 'P' || p_partkey AS gene, 'chr' || (p_partkey % 5 + 1) AS chrom,
                   (p_partkey * 104729) % 3000000 AS lo,
                   CAST(power(10, p_partkey % 7) AS BIGINT) * (1 + p_size % 9) // 9 AS length,
                   p_partkey * 7 % 1009 * 1000000 + p_partkey AS ord
            FROM part),
        sites AS (
            SELECT 'chr' || (l_partkey % 5 + 1) AS chromosome,
                   (l_partkey * 131 + l_suppkey * 7919) % 3000000 AS position, count(*) AS line_count
            FROM lineitem GROUP BY ALL)
        SELECT chromosome, position, line_count,
               (SELECT arg_max(gene, ord) FROM regions
                WHERE chrom = chromosome AND position BETWEEN lo AND lo + length) AS gene_symbol
        FROM sites""",
    "impact_ranks": sql(
        RANKED,
        """SELECT row_number() OVER (
                      ORDER BY score DESC, drug_name, gene_symbol, population_code,
                               classification_strength, delta_vs_baseline DESC) AS rank_position,
                  drug_name, gene_symbol, population_code, classification_strength, delta_vs_baseline
           FROM scored""",
    ),
    "clustered_calls": sql(
        FACTS,
        """SELECT DATE '2025-01-01' AS ingest_date, chromosome AS chromosome_part, count(*) AS call_count,
                  min(position) AS first_position, max(position) AS last_position,
                  CAST(sum(allele_dosage) AS BIGINT) AS dosage_sum
           FROM variants GROUP BY chromosome""",
    ),
    "dosage_from_buckets": sql(
        PEOPLE, "SELECT sample_id, population_code, superpopulation, gene_symbol, total_dosage FROM people"
    ),
    "joint_impact_from_buckets": sql(JOINT, f"SELECT {IMPACT_COLUMNS} FROM joint"),
    "latest_stored_date": sql(
        ["samples"],
        """SELECT DATE '2025-01-03' AS ingest_date, population_code, count(*) AS sample_count
           FROM samples WHERE CAST(substr(sample_id, 2) AS BIGINT) % 3 + 1 = 3
           GROUP BY population_code""",
    ),
    "stored_upsert": sql(
        ["samples"],
        """SELECT superpopulation, population_code, count(*) AS sample_count FROM samples
           WHERE superpopulation IN ('ASIA', 'EUROPE') OR CAST(substr(sample_id, 2) AS BIGINT) % 4 = 0
           GROUP BY ALL""",
    ),
    "export_populations": sql(COHORTS, "SELECT * FROM populations ORDER BY population_code"),
    "export_metadata": sql(
        [*FREQUENCIES, *COHORTS],
        """SELECT '1.0.0' AS schema_version, DATE '2025-01-01' AS snapshot_date,
                  (SELECT count(*) FROM frequencies) AS total_variants_analyzed,
                  population_code, population_name AS name, region, superpopulation, sample_size
           FROM populations""",
    ),
    "typed_result_rows": """
        WITH typed AS (
            SELECT l_orderkey,
                   CASE WHEN l_linenumber <> 3 THEN CAST(l_linenumber AS BIGINT) END AS line,
                   CASE WHEN l_returnflag <> 'R' THEN round_even(l_tax, 6) END AS tax,
                   CASE WHEN l_linestatus = 'F' THEN FALSE ELSE l_discount > 0.05 END
                       AS discounted,
                   CASE WHEN l_returnflag <> 'A' THEN l_returnflag END AS flag
            FROM lineitem)
        SELECT line, tax, discounted, flag, count(*) AS order_count,
               CAST(sum(l_orderkey) AS BIGINT) AS order_sum
        FROM typed GROUP BY line, tax, discounted, flag""",
    "maf_filter": sql(
        FREQUENCIES,
        f"""SELECT {FREQUENCY_COLUMNS} FROM frequencies
            WHERE least(allele_frequency, 1 - allele_frequency) > 0.45""",
    ),
    "top_variants_per_gene": sql(
        FREQUENCIES,
        f"""SELECT {FREQUENCY_COLUMNS} FROM frequencies SEMI JOIN (
                SELECT gene_symbol, variant_id FROM frequencies
                GROUP BY gene_symbol, variant_id
                QUALIFY row_number() OVER (
                    PARTITION BY gene_symbol
                    ORDER BY max(abs(delta_vs_ceu)) DESC NULLS LAST, variant_id) <= 3) chosen
            USING (gene_symbol, variant_id)""",
    ),
    "hemizygous_totals": sql(
        [*FACTS, *CLINICAL, "hemizygous_counts", "rated", "frequencies"],
        f"SELECT {FREQUENCY_COLUMNS} FROM frequencies",
    ),
    "upsert_snapshot": sql(
        [*IMPACT],
        f""", strong AS (SELECT * FROM summed_strong),
           updates AS (
               SELECT s.*, coalesce(b.percentage_requiring_change, 0.0)
                          AS baseline_ceu_percentage,
                      round_even(s.percentage_requiring_change
                                 - coalesce(b.percentage_requiring_change, 0.0), 2)
                          AS delta_vs_baseline,
                      DATE '2025-01-01' AS snapshot_date
               FROM strong s LEFT JOIN strong b
                   ON b.population_code = 'NATION_0' AND b.drug_name = s.drug_name
                  AND b.gene_symbol = s.gene_symbol
                  AND b.classification_strength = s.classification_strength)
           SELECT {IMPACT_COLUMNS} FROM impact i WHERE NOT EXISTS (
               SELECT 1 FROM updates u WHERE u.drug_name = i.drug_name
                   AND u.gene_symbol = i.gene_symbol
                   AND u.population_code = i.population_code
                   AND u.classification_strength = i.classification_strength)
           UNION ALL SELECT {IMPACT_COLUMNS} FROM updates""".replace(
            "SELECT * FROM summed_strong",
            "SELECT * FROM summed WHERE classification_strength = 'Strong'",
        ),
    ),
}

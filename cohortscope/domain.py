"""Fixed values of the domain: genes, cohorts, guidance.

Everything here is data that results depend on literally. Nothing is computed except
the guidance rows that differ only in the drug name.
"""

from __future__ import annotations

# --- Fixed values: study genes -------------------------------------------------------

# gene -> (chromosome, start, end); GRCh37, 1-based, both ends inclusive.
GENE_REGIONS = {
    "CYP2C19": ("chr10", 96_510_000, 96_612_671),
    "CYP2C9": ("chr10", 96_698_415, 96_749_148),
    "SLCO1B1": ("chr12", 21_282_444, 21_394_730),
    "VKORC1": ("chr16", 31_090_000, 31_106_234),
    "TPMT": ("chr6", 18_128_556, 18_155_418),
    "NUDT15": ("chr13", 48_600_074, 48_609_007),
    "DPYD": ("chr1", 97_543_300, 98_386_615),
    "G6PD": ("chrX", 153_759_605, 153_798_257),
    "IFNL3": ("chr19", 39_729_165, 39_756_700),
    "CYP3A5": ("chr7", 99_245_817, 99_277_621),
    "UGT1A9": ("chr2", 234_575_000, 234_681_946),
}

REGION_BUFFER_BP = 10_000

# gene -> ids of the variants whose dosage decides the phenotype.
KEY_VARIANTS = {
    "CYP2C19": ("chr10:96521657", "chr10:96540410"),
    "CYP2C9": ("chr10:96741053",),
    "SLCO1B1": ("chr12:21331549",),
    "VKORC1": ("chr16:31093954",),
    "TPMT": ("chr6:18131419",),
    "NUDT15": ("chr13:48605878",),
    "DPYD": ("chr1:97981343", "chr1:97915614", "chr1:97981395"),
    "G6PD": ("chrX:153763492", "chrX:153764217"),
    "IFNL3": ("chr19:39747741",),
    "CYP3A5": ("chr7:99270539",),
    "UGT1A9": ("chr2:234578428",),
}

# Genes whose reference allele is the non-functional one.
INVERTED_GENES = ("CYP3A5",)

# Category for 0, 1 and 2 or more non-functional copies.
DEFAULT_CATEGORIES = ("Normal Metabolizer", "Intermediate Metabolizer", "Poor Metabolizer")
GENE_CATEGORIES = {
    "IFNL3": ("Favorable Genotype", "Intermediate Genotype", "Unfavorable Genotype"),
    "G6PD": ("Normal", "Deficient", "Deficient"),
    "VKORC1": ("Normal Sensitivity", "Intermediate Sensitivity", "High Sensitivity"),
    "SLCO1B1": ("Normal Function", "Decreased Function", "Poor Function"),
}
UNKNOWN_CATEGORY = "Indeterminate"

# (gene, cohort, allele frequency, label of the source)
LITERATURE_FREQUENCIES = (("NUDT15", "PUR", 0.031, "literature_1000G_gnomAD"),)
OBSERVED_SOURCE = "vcf_1000G_phase3"

# (symbol, in scope, rationale)
GENE_SCOPE = (
    ("CYP2C19", True, "CPIC A-level; star alleles called from SNPs only (no CNV requirement)"),
    ("CYP2C9", True, "CPIC A-level; SNP-based calling; warfarin dosing algorithm"),
    (
        "SLCO1B1",
        True,
        "CPIC A-level; rs4149056 single-variant actionability for statin myopathy",
    ),
    ("VKORC1", True, "CPIC A-level; warfarin dosing algorithm component"),
    ("TPMT", True, "CPIC A-level; thiopurine toxicity; high clinical impact in oncology"),
    (
        "NUDT15",
        True,
        "CPIC A-level; thiopurine toxicity; particularly relevant in "
        "East/South Asian and Hispanic ancestry",
    ),
    (
        "DPYD",
        True,
        "CPIC A-level; fluoropyrimidine toxicity; relevant in GI and breast oncology",
    ),
    (
        "G6PD",
        True,
        "CPIC A-level; hemolytic anemia risk; high deficiency prevalence in LATAM "
        "populations (Afro-Caribbean ancestry)",
    ),
    (
        "IFNL3",
        True,
        "CPIC A-level; peginterferon response; HCV treatment relevance in LATAM",
    ),
    ("CYP3A5", True, "CPIC A-level; tacrolimus dosing; relevant for solid organ transplant"),
    (
        "UGT1A9",
        True,
        "CPIC B-level; mycophenolate dosing in transplant patients; "
        "SNP-based calling; no CNV complexity; "
        "*3 prevalent in Hispanic and African ancestry",
    ),
    (
        "CYP2D6",
        False,
        "EXCLUDED: copy number variation (CNV) and complex star-allele structure "
        "require a dedicated caller (Aldy or PyPGx) applied to WGS BAMs. "
        "Standard VCF genotypes are insufficient for reliable diplotype calling. "
        "Will be addressed in a future phase with an appropriate caller.",
    ),
)

# --- Fixed values: cohorts -----------------------------------------------------------

BASELINE_COHORT = "CEU"

# code -> (name, region)
COHORTS = {
    "MXL": ("Mexican Ancestry in Los Angeles, California", "Latin America"),
    "PEL": ("Peruvians in Lima, Peru", "Latin America"),
    "CLM": ("Colombians in Medellín, Colombia", "Latin America"),
    "PUR": ("Puerto Ricans in Puerto Rico", "Latin America"),
    "CEU": ("Utah Residents (CEPH) with Northern and Western European Ancestry", "Europe"),
    "TSI": ("Toscani in Italia", "Europe"),
    "FIN": ("Finnish in Finland", "Europe"),
    "GBR": ("British in England and Scotland", "Europe"),
    "IBS": ("Iberian Population in Spain", "Europe"),
    "YRI": ("Yoruba in Ibadan, Nigeria", "Sub-Saharan Africa"),
    "LWK": ("Luhya in Webuye, Kenya", "Sub-Saharan Africa"),
    "GWD": ("Gambian in Western Divisions in the Gambia", "Sub-Saharan Africa"),
    "MSL": ("Mende in Sierra Leone", "Sub-Saharan Africa"),
    "ESN": ("Esan in Nigeria", "Sub-Saharan Africa"),
    "ASW": ("African Ancestry in Southwest USA", "African American"),
    "ACB": ("African Caribbeans in Barbados", "African Caribbean"),
    "CHB": ("Han Chinese in Beijing, China", "East Asia"),
    "JPT": ("Japanese in Tokyo, Japan", "East Asia"),
    "CHS": ("Southern Han Chinese", "East Asia"),
    "CDX": ("Chinese Dai in Xishuangbanna, China", "East Asia"),
    "KHV": ("Kinh in Ho Chi Minh City, Vietnam", "East Asia"),
    "GIH": ("Gujarati Indian from Houston, Texas", "South Asia"),
    "PJL": ("Punjabi from Lahore, Pakistan", "South Asia"),
    "BEB": ("Bengali from Bangladesh", "South Asia"),
    "STU": ("Sri Lankan Tamil from the UK", "South Asia"),
    "ITU": ("Indian Telugu from the UK", "South Asia"),
}

# Country shown in the text documents.
COHORT_COUNTRIES = {
    "ACB": "Barbados (African Caribbean)",
    "ASW": "USA (African American SW)",
    "CLM": "Colombia",
    "MXL": "Mexico (Los Angeles)",
    "PEL": "Peru",
    "PUR": "Puerto Rico",
    "CEU": "Europe (Utah Residents)",
    "GBR": "Great Britain",
    "FIN": "Finland",
    "IBS": "Spain (Iberian)",
    "TSI": "Italy (Tuscan)",
    "CHB": "China (Han Beijing)",
    "JPT": "Japan (Tokyo)",
    "CHS": "China (Southern Han)",
    "CDX": "China (Dai Xishuangbanna)",
    "KHV": "Vietnam (Kinh Ho Chi Minh)",
    "GIH": "India (Gujarati)",
    "PJL": "Pakistan (Punjabi Lahore)",
    "BEB": "Bangladesh",
    "STU": "Sri Lanka (Tamil UK)",
    "ITU": "India (Telugu UK)",
    "LWK": "Kenya (Luhya Webuye)",
    "MSL": "Sierra Leone (Mende)",
    "GWD": "Gambia (Mandinka)",
    "YRI": "Nigeria (Yoruba Ibadan)",
    "ESN": "Nigeria (Esan)",
}

# --- Fixed values: guidance ----------------------------------------------------------

ACTIONABLE_EVIDENCE = ("1A", "1B")

STRENGTH_WEIGHTS = {"Strong": 1.0, "Moderate": 0.7, "Optional": 0.3}
DEFAULT_STRENGTH_WEIGHT = 0.3

RANKING_SIZE = 50

DOSE_CHANGE_PATTERNS = (
    r"\breduce\b",
    r"\breduction\b",
    r"\blower (the |a |your )?dose\b",
    r"\bdose (reduction|adjustment|decrease)\b",
    r"\badjust(ed)? dose\b",
    r"\bstart (at|with) (a )?lower\b",
    r"\btitrat",
    r"\b\d+\s*%\s*(of|reduction)\b",
    r"\bmodified dose\b",
    r"\bdosage adjustment\b",
    r"\bdecrease (the )?dose\b",
    r"\bincrease (starting |the )?dose\b",
)

ALTERNATIVE_PATTERNS = (
    r"\bavoid\b",
    r"\balternative\b",
    r"\bcontraindicated\b",
    r"\bdo not use\b",
    r"\bswitch\b",
    r"\bselect an?other\b",
    r"\bconsider an?other\b",
    r"\buse an?other\b",
    r"\bnot recommended\b",
    r"\bsubstitut\b",
)

UNGRADED_STRENGTHS = ("", "no recommendation")

# Joint dosing: pairs that are not listed take the standard dose.
JOINT_DRUG = "warfarin"
JOINT_GENES = ("VKORC1", "CYP2C9")
JOINT_STRENGTH = "Strong"
STANDARD_DOSE = "standard"
JOINT_DOSES = {
    ("Intermediate Sensitivity", "Intermediate Metabolizer"): "low",
    ("Intermediate Sensitivity", "Poor Metabolizer"): "low",
    ("High Sensitivity", "Normal Metabolizer"): "low",
    ("High Sensitivity", "Intermediate Metabolizer"): "low",
    ("High Sensitivity", "Poor Metabolizer"): "low",
}

# Variants kept in the small frequency export.
EXPORT_VARIANT_IDS = (
    "chr10:96521657",
    "chr10:96540410",
    "chr10:96741053",
    "chr12:21331549",
    "chr16:31093954",
    "chr7:99251073",
    "chr2:234578428",
    "chr6:18131419",
    "chr1:97981343",
    "chr1:97915614",
    "chr1:97981395",
    "chrX:153763492",
    "chrX:153764217",
)

DOCUMENT_PREFIX = "gold/kb-docs"

ARTIFACT_SCHEMA_VERSION = "1.0.0"
ARTIFACT_SOURCE_VERSIONS = {
    "thousand_genomes": "Phase 3 GRCh37 (20130502)",
    "pharmgkb": "latest at ingest date",
    "cpic": "v4 PostgREST API",
}

# Curated guidance: (gene, drug, phenotype, text, strength, dose change, alternative, version)
CURATED_GUIDANCE = (
    (
        "VKORC1", "warfarin", "Normal Sensitivity",
        "Initiate therapy with standard recommended dose.",
        "Strong", False, False, "v1.4-2017",
    ),
    (
        "VKORC1", "warfarin", "Intermediate Sensitivity",
        "Consider moderate dose reduction based on VKORC1 sensitivity genotype.",
        "Strong", True, False, "v1.4-2017",
    ),
    (
        "VKORC1", "warfarin", "High Sensitivity",
        "Consider significant dose reduction based on VKORC1 high sensitivity genotype.",
        "Strong", True, False, "v1.4-2017",
    ),
    (
        "IFNL3", "peginterferon alfa-2a", "Favorable Genotype",
        "Initiate peginterferon alfa-2a plus ribavirin at standard doses. "
        "CC genotype (favorable) is associated with approximately 70% sustained virologic "
        "response (SVR) rate in HCV genotype 1 patients.",
        "Strong", False, False, "v1.0-2014",
    ),
    (
        "IFNL3", "peginterferon alfa-2a", "Intermediate Genotype",
        "Initiate peginterferon alfa-2a plus ribavirin at standard doses. "
        "CT genotype (intermediate) is associated with intermediate SVR rates (~40-50%). "
        "Enhanced monitoring is recommended.",
        "Strong", False, False, "v1.0-2014",
    ),
    (
        "IFNL3", "peginterferon alfa-2a", "Unfavorable Genotype",
        "Consider alternative therapy. TT genotype (unfavorable) is associated with "
        "approximately 25-30% SVR rate for HCV genotype 1. "
        "Direct-acting antiviral (DAA) regimens are preferred when available, "
        "as they are not impacted by IFNL3 genotype.",
        "Strong", False, True, "v1.0-2014",
    ),
    (
        "IFNL3", "peginterferon alfa-2b", "Favorable Genotype",
        "Initiate peginterferon alfa-2b plus ribavirin at standard doses. "
        "CC genotype (favorable) is associated with approximately 70% SVR rate "
        "in HCV genotype 1 patients.",
        "Strong", False, False, "v1.0-2014",
    ),
    (
        "IFNL3", "peginterferon alfa-2b", "Intermediate Genotype",
        "Initiate peginterferon alfa-2b plus ribavirin at standard doses. "
        "CT genotype (intermediate) is associated with intermediate SVR rates. "
        "Enhanced monitoring is recommended.",
        "Strong", False, False, "v1.0-2014",
    ),
    (
        "IFNL3", "peginterferon alfa-2b", "Unfavorable Genotype",
        "Consider alternative therapy. TT genotype (unfavorable) is associated with "
        "approximately 25-30% SVR rate for HCV genotype 1. "
        "DAA regimens are preferred when available.",
        "Strong", False, True, "v1.0-2014",
    ),
    (
        "UGT1A9", "mycophenolate mofetil", "Normal Metabolizer",
        "Initiate therapy with standard recommended dose of mycophenolate mofetil. "
        "No genotype-based dose adjustment required.",
        "Moderate", False, False, "v1.0-2021",
    ),
    (
        "UGT1A9", "mycophenolate mofetil", "Intermediate Metabolizer",
        "Initiate therapy with standard recommended dose. "
        "Enhanced therapeutic drug monitoring may be warranted due to genotype-predicted "
        "intermediate UGT1A9 activity and potential for altered MPA exposure.",
        "Moderate", False, False, "v1.0-2021",
    ),
    (
        "UGT1A9", "mycophenolate mofetil", "Poor Metabolizer",
        "Consider dose reduction of mycophenolate mofetil. "
        "UGT1A9*3/*3 genotype predicts substantially reduced glucuronidation and higher "
        "mycophenolic acid (MPA) systemic exposure; dose reduction and enhanced "
        "monitoring recommended.",
        "Moderate", True, False, "v1.0-2021",
    ),
    (
        "TPMT", "azathioprine", "Normal Metabolizer",
        "Initiate therapy with standard weight-based dosing of azathioprine. "
        "No genotype-based dose adjustment required for TPMT Normal Metabolizers. "
        "Adjust doses based on disease-specific guidelines and tolerance.",
        "Strong", False, False, "v1.3-2019",
    ),
    (
        "TPMT", "azathioprine", "Intermediate Metabolizer",
        "Initiate therapy with reduced starting doses (30-70% of standard starting dose) "
        "of azathioprine for TPMT Intermediate Metabolizers. "
        "Titrate based on disease response and tolerance.",
        "Strong", True, False, "v1.3-2019",
    ),
    (
        "TPMT", "azathioprine", "Possible Intermediate Metabolizer",
        "Initiate therapy with reduced starting doses (30-70% of standard starting dose) "
        "of azathioprine for TPMT Possible Intermediate Metabolizers. "
        "Titrate based on disease response and tolerance.",
        "Strong", True, False, "v1.3-2019",
    ),
    (
        "NUDT15", "azathioprine", "Normal Metabolizer",
        "Initiate therapy with standard weight-based dosing of azathioprine. "
        "No genotype-based dose adjustment required for NUDT15 Normal Metabolizers. "
        "Monitor and adjust doses per disease-specific protocol.",
        "Strong", False, False, "v1.3-2019",
    ),
    (
        "SLCO1B1", "fluvastatin", "Normal Function",
        "Prescribe desired starting dose and adjust doses of fluvastatin based on "
        "disease-specific guidelines. No genotype-based dose adjustment required for "
        "SLCO1B1 Normal Function individuals.",
        "Moderate", False, False, "v2.4-2022",
    ),
    (
        "SLCO1B1", "rosuvastatin", "Normal Function",
        "Prescribe desired starting dose and adjust doses of rosuvastatin based on "
        "disease-specific guidelines. No genotype-based dose adjustment required for "
        "SLCO1B1 Normal Function individuals.",
        "Optional", False, False, "v2.4-2022",
    ),
    (
        "SLCO1B1", "rosuvastatin", "Increased Function",
        "Prescribe desired starting dose and adjust doses of rosuvastatin based on "
        "disease-specific guidelines. SLCO1B1 Increased Function individuals are not "
        "at elevated risk; no genotype-based restriction required.",
        "Optional", False, False, "v2.4-2022",
    ),
)

# Drugs that share one curated row for the G6PD category "Normal".
G6PD_DRUGS = (
    "aminosalicylic acid",
    "aspirin",
    "chloramphenicol",
    "chloroquine",
    "ciprofloxacin",
    "dapsone",
    "dimercaprol",
    "doxorubicin",
    "furazolidone",
    "glyburide",
    "hydroxychloroquine",
    "mafenide",
    "methylene blue",
    "nalidixic acid",
    "nitrofurantoin",
    "norfloxacin",
    "ofloxacin",
    "pegloticase",
    "phenazopyridine",
    "primaquine",
    "quinine",
    "rasburicase",
    "sulfadiazine",
    "sulfadimidine",
    "sulfamethoxazole / trimethoprim",
    "sulfanilamide",
    "sulfasalazine",
    "sulfisoxazole",
    "tafenoquine",
    "tolbutamide",
    "toluidine blue",
    "vitamin c",
    "vitamin k",
)
G6PD_TEXT = (
    "No genotype-based dose adjustment or alternative therapy required. "
    "G6PD Normal individuals have adequate enzyme activity; "
    "prescribe desired dose per standard disease-specific guidelines."
)


def curated_guidance() -> list[tuple]:
    """All curated rows, the shared ones spelled out per drug."""
    shared = [
        ("G6PD", drug, "Normal", G6PD_TEXT, "Strong", False, False, "v1.0-2022")
        for drug in G6PD_DRUGS
    ]
    return [*CURATED_GUIDANCE, *shared]

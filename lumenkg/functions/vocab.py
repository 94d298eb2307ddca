"""Fixed values.

Everything in this module is a constant whose exact value decides the
results (dictionary terms, regular expressions, formats, URI prefixes,
the prompt text).  They are stated plainly, in their natural order, so
that results match the behaviour this engine re-implements.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: basic dictionaries used by the HTML / API / minimal paths
# ---------------------------------------------------------------------------
BASIC_ORGANISMS = [
    "Escherichia coli", "E. coli", "Saccharomyces cerevisiae",
    "Arabidopsis", "Drosophila", "mice", "mouse", "rats", "rat",
    "human", "humans", "cells", "bacteria", "yeast", "zebrafish",
    "C. elegans", "Caenorhabditis elegans",
]
# Compared *unlowered* against lower-cased text (so "ISS" never matches).
BASIC_KEYWORDS = [
    "microgravity", "weightlessness", "space", "orbital", "ISS",
    "astronaut", "spaceflight", "radiation", "hypergravity",
    "bone loss", "muscle atrophy", "space medicine", "astrobiology",
]
BASIC_CONDITIONS = [
    "microgravity", "simulated microgravity", "centrifuge",
    "space environment", "radiation exposure", "isolation",
    "confined space", "altered gravity",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: NLP gazetteers, profile "main"
# ---------------------------------------------------------------------------
MAIN_GAZETTEER = {
    "organisms": [
        "human", "mouse", "mice", "rat", "drosophila", "arabidopsis",
        "caenorhabditis elegans", "c. elegans", "saccharomyces cerevisiae",
        "escherichia coli", "e. coli", "bacillus subtilis", "zebrafish",
    ],
    "space_conditions": [
        "microgravity", "hypergravity", "weightlessness", "zero gravity",
        "cosmic radiation", "space radiation", "solar radiation",
        "magnetic field", "space environment", "orbital flight",
        "parabolic flight", "centrifuge", "clinostat", "rpms",
    ],
    "biological_systems": [
        "cardiovascular", "musculoskeletal", "nervous system", "immune system",
        "bone", "muscle", "heart", "brain", "kidney", "liver",
        "bone density", "muscle atrophy", "osteoporosis",
    ],
    "experiments": [
        "gene expression", "protein analysis", "cell culture",
        "tissue engineering", "metabolomics", "proteomics", "genomics",
        "transcriptomics", "histology", "microscopy",
    ],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: NLP gazetteers, profile "strict"
# ---------------------------------------------------------------------------
STRICT_GAZETTEER = {
    "organisms": [
        "human", "mouse", "mice", "rat", "drosophila", "arabidopsis",
        "caenorhabditis elegans", "c. elegans", "saccharomyces cerevisiae",
        "escherichia coli", "e. coli", "bacillus subtilis",
    ],
    "space_conditions": [
        "microgravity", "hypergravity", "weightlessness", "zero gravity",
        "cosmic radiation", "space radiation", "solar radiation",
        "magnetic field", "space environment", "orbital flight",
        "parabolic flight", "centrifuge", "clinostat", "rpms",
    ],
    "biological_systems": [
        "cardiovascular", "musculoskeletal", "nervous system", "immune system",
        "bone", "muscle", "heart", "brain", "kidney", "liver",
        "bone density", "muscle atrophy", "osteoporosis",
    ],
    "experiments": [
        "gene expression", "protein analysis", "cell culture",
        "tissue engineering", "metabolomics", "proteomics", "genomics",
        "transcriptomics", "histology", "microscopy",
    ],
    "measurements": [
        "body mass", "bone density", "muscle strength", "heart rate",
        "blood pressure", "hormone levels", "gene expression levels",
        "protein concentration", "cell viability", "proliferation rate",
    ],
}

# ---------------------------------------------------------------------------
# FIXED VALUES: entity regular expressions (Python `re` syntax).
# ---------------------------------------------------------------------------
GENE_PATTERN = r"\b[A-Z][A-Z0-9]{2,}(?:-[A-Z0-9]+)?\b"
PROTEIN_PATTERN = r"\b[A-Z][a-z]+(?:-\d+)?(?:\s+[A-Z][a-z]*)*\b"
MEASUREMENT_PATTERN = r"\d+(?:\.\d+)?\s*(?:mg|g|kg|ml|l|μm|mm|cm|m|°C|%|ppm|μg)"
TIME_PERIOD_PATTERN = r"\d+\s*(?:days?|weeks?|months?|years?|hrs?|hours?|mins?|minutes?)"
# FIXED VALUES, opt-in: leading matches kept per family.  By default all
# matches are kept; pass this as ``limits`` to cut the lists.
ENTITY_LIMITS = {"genes": 10, "proteins": 10, "measurements": 15}

# NER label routing: label -> article field (genes need length > 2)
NER_ROUTES = [
    (("SPECIES", "TAXON"), "organisms"),
    (("GENE", "PROTEIN"), "genes"),
    (("CHEMICAL", "DRUG"), "measurements"),
    (("DISEASE", "CONDITION"), "conditions"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: dates.  strptime formats in order, their Spark equivalents,
# and the publication-date text patterns in order.
# ---------------------------------------------------------------------------
DATE_FORMATS_PY = ["%Y-%m-%d", "%Y/%m/%d", "%B %d, %Y", "%b %d, %Y", "%d %B %Y", "%d %b %Y", "%Y"]
DATE_FORMATS_SPARK = ["yyyy-M-d", "yyyy/M/d", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy", "yyyy"]
# Shape of a string each format can possibly accept (cheap pre-test; a parse that fails costs a raised exception,
# so a month name is only given to the format that reads names of its length)
_MONTHS = r"(?i:january|february|march|april|may|june|july|august|september|october|november|december)"
_MONTHS_SHORT = r"(?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
DATE_FORMAT_SHAPES = [
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", r"^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}$",
    rf"^{_MONTHS} [0-9]{{1,2}}, [0-9]{{4}}$", rf"^{_MONTHS_SHORT} [0-9]{{1,2}}, [0-9]{{4}}$",
    rf"^[0-9]{{1,2}} {_MONTHS} [0-9]{{4}}$", rf"^[0-9]{{1,2}} {_MONTHS_SHORT} [0-9]{{4}}$", r"^[0-9]{4}$",
]
PUBLISHED_DATE_PATTERNS = [
    r"Published[:\s]+([A-Za-z]+\s+\d{1,2},?\s+\d{4})",
    r"(\d{4}-\d{2}-\d{2})",
    r"([A-Za-z]+\s+\d{1,2},?\s+\d{4})",
]

# ---------------------------------------------------------------------------
# FIXED VALUES: HTML selectors
# ---------------------------------------------------------------------------
REMOVED_TAGS = ["script", "style", "nav", "footer", "header"]
ABSTRACT_SELECTORS = [".abstract", "#abstract", ".article-abstract", ".summary"]
CONTENT_SELECTORS = [".article-content", ".main-content", ".content", "main", "article"]
JOURNAL_SELECTORS = [
    ".journal-title", ".journal-name", '[data-testid="journal-title"]',
    "h1.journal", ".site-header .journal",
]
DOI_TEXT_PATTERN = r"10\.\d{4,}[^\s]*"
CONTENT_MIN_CHARS = 500

# ---------------------------------------------------------------------------
# FIXED VALUES, opt-in: text cuts.  By default whole texts are used; each is
# passed to the function named beside it.
# ---------------------------------------------------------------------------
PAGE_TEXT_CHARS = 3000          # parse_pages(max_chars=)
HTML_ABSTRACT_PREFIX = 500      # html_fallback_abstract(prefix=): that many chars + "..."
PROMPT_CONTENT_CHARS = 4000     # prompt_text(content_chars=)
NLP_TEXT_CHARS = {"main": 3000, "strict": 5000}  # nlp_text(max_chars=)

# ---------------------------------------------------------------------------
# FIXED VALUES: thresholds
# ---------------------------------------------------------------------------
HTML_SHORT_TEXT = 1000          # below: the whole text is the abstract
HTML_ABSTRACT_LINE_MIN = 100    # a line containing "abstract" must be longer
LLM_MIN_SCORE = 0.3             # cascade keeps an LLM article above this
FALLBACK_MIN_SCORE = 0.2        # PMC / HTML candidates kept above this
VALIDATE_THRESHOLD = {"main": 0.2, "strict": 0.5}
TITLE_SIMILARITY_THRESHOLD = 85
SPACE_RELEVANCE_TERMS = ["microgravity", "space", "astronaut", "ISS"]
QUALITY_THRESHOLDS = {"min_title_length": 10, "min_abstract_length": 100, "min_full_text_length": 1000}

# LLM providers in their fixed priority order
LLM_PROVIDERS = ["deepseek", "groq", "together", "perplexity"]

# ---------------------------------------------------------------------------
# FIXED VALUES: URIs
# ---------------------------------------------------------------------------
BASE_URI = "http://space-biology.org/"
ARTICLE_URI = BASE_URI + "article/"
SCHEMA_NS = "https://schema.org/"
BIO_NS = "http://purl.obolibrary.org/obo/"
SPACE_NS = "http://space-biology.org/ontology/"
DCTERMS_NS = "http://purl.org/dc/terms/"
FOAF_NS = "http://xmlns.com/foaf/0.1/"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
JSONLD_CONTEXT = {
    "schema": "https://schema.org/",
    "bio": "http://purl.obolibrary.org/obo/",
    "dcterms": "http://purl.org/dc/terms/",
    "foaf": "http://xmlns.com/foaf/0.1/",
}

# ---------------------------------------------------------------------------
# FIXED VALUES: extraction prompt ({text} is replaced by the prepared text)
# ---------------------------------------------------------------------------
EXTRACTION_PROMPT = """
You are a scientific data extraction expert specializing in space biology research. 
Analyze the following scientific article text and extract structured information in JSON format.

Text to analyze:
{text}

Please extract and return ONLY a valid JSON object with the following structure:
{
    "title": "Article title",
    "abstract": "Article abstract or summary",
    "journal": "Journal name if found",
    "authors": [
        {"name": "Author Name", "affiliation": "Institution if found"}
    ],
    "keywords": ["keyword1", "keyword2"],
    "organisms": ["organism1", "organism2"],
    "genes": ["gene1", "gene2"],
    "proteins": ["protein1", "protein2"],
    "conditions": ["space condition1", "microgravity", "radiation"],
    "experiments": ["experiment type1", "methodology"],
    "measurements": ["measurement1 with units", "parameter2"],
    "publication_date": "YYYY-MM-DD or null",
    "doi": "DOI if found or null",
    "confidence_score": 0.85
}

Focus on space biology, microgravity research, and related fields. Return only valid JSON without explanations.
"""

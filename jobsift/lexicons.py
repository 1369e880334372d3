"""Word lists, patterns and constants that decide the results.

Every value in this module is a FIXED VALUE: it has to equal the published
list for the results to be right, so it is stated as plain text in its natural
order.  Order matters where ties are broken by it (skills, label areas).
Every operator takes its list as a parameter, these are only the defaults.
"""

# --------------------------------------------------------------------------
# collection
# --------------------------------------------------------------------------
SITE_DOMAIN = "https://weworkremotely.com"
SOURCE_NAME = "WeWorkRemotely"
LINK_PREFIX = "/remote-jobs/"
CATEGORY_URLS = [
    "https://weworkremotely.com/remote-full-time-jobs",
    "https://weworkremotely.com/categories/remote-back-end-programming-jobs",
    "https://weworkremotely.com/categories/remote-front-end-programming-jobs",
    "https://weworkremotely.com/categories/remote-full-stack-programming-jobs",
    "https://weworkremotely.com/categories/remote-devops-sysadmin-jobs",
    "https://weworkremotely.com/categories/remote-design-jobs",
    "https://weworkremotely.com/categories/remote-product-jobs",
    "https://weworkremotely.com/categories/remote-customer-support-jobs",
    "https://weworkremotely.com/categories/remote-finance-legal-jobs",
    "https://weworkremotely.com/categories/remote-data-jobs",
    "https://weworkremotely.com/categories/remote-business-exec-management-jobs",
    "https://weworkremotely.com/categories/remote-marketing-jobs",
]
PAGES_PER_CATEGORY = 5
MAX_JOBS = 500
MIN_LINKS_TO_CONTINUE = 5
FALLBACK_TEXT_CHARS = 2000

# --------------------------------------------------------------------------
# Regular expressions of the posting features
# --------------------------------------------------------------------------
SENIORITY_PATTERN = (
    r"\b(est[aá]gio|intern(ship)?|junior|j[úu]nior|jr\.?|pleno|mid( level)?"
    r"|senior|s[êe]nior|sr\.?|lead|staff|principal)\b"
)
REGIME_PATTERN = (
    r"\b(remoto|remote|h[ií]brido|hybrid|presencial|on[-\s]?site|in[-\s]?office)\b"
)
SALARY_PATTERN = (
    r"(R\$\s?\d+(\.\d{3})*(,\d{2})?)|(\$\s?\d{2,3}(,\d{3})*(\.\d{2})?)|(\b\d{2,3}k\b)"
)
WORKLOAD_PATTERN = (
    r"\b(\d{1,2}\s?h\s*/\s*semana|\d{1,2}\s?h/semana"
    r"|\d{1,2}\s*hours?\s*/\s*week|\d{1,2}\s*hours?\s*per\s*week)\b"
)
URL_PATTERN = r"https?://\S+|www\.\S+"
EMAIL_PATTERN = r"\b[\w\.-]+@[\w\.-]+\.\w+\b"
MAX_LINKS_KEPT = 5

# --------------------------------------------------------------------------
# Skills looked for in a posting (64) and in the reports (31)
# --------------------------------------------------------------------------
POSTING_SKILLS = [
    "python", "sql", "spark", "airflow", "power bi", "tableau", "aws", "gcp",
    "azure", "docker", "kubernetes", "react", "javascript", "typescript", "node",
    "java", "c#", "go", "rust", "django", "flask", "fastapi", "postgres", "mysql",
    "snowflake", "databricks", "dbt", "etl", "api", "ci/cd", "terraform", "rails",
    "ruby", "graphql", "redis", "mongodb", "elasticsearch", "kafka", "next.js",
    "vue", "angular", "svelte", "flutter", "swift", "kotlin", "react native",
    "figma", "selenium", "cypress", "playwright", "pytorch", "tensorflow",
    "pandas", "scikit-learn", "jenkins", "github actions", "datadog", "spring",
    "laravel", "php", "scala", ".net", "rabbitmq", "grpc",
]
REPORT_SKILLS = [
    "python", "sql", "spark", "airflow", "power bi", "tableau", "aws", "gcp",
    "azure", "docker", "kubernetes", "react", "javascript", "typescript", "node",
    "java", "c#", "go", "rust", "django", "flask", "fastapi", "postgres", "mysql",
    "snowflake", "databricks", "dbt", "etl", "api", "ci/cd", "terraform",
]
NO_SENIORITY = "Sem"

# --------------------------------------------------------------------------
# Area labels, in the order of the confusion matrix
# --------------------------------------------------------------------------
AREA_LABELS = [
    "Dados", "Backend", "Frontend", "DevOps", "Mobile", "Produto", "QA",
    "Design", "Security", "Outro",
]
OTHER_AREA = "Outro"

# Keyword evidence per area: {area: {weight: [keywords]}}.  The order of the
# areas breaks ties between equal scores.
AREA_KEYWORDS = {
    "Dados": {
        3: ["data engineer", "data scientist", "data analyst", "machine learning",
            "data warehouse", "business intelligence", "mlops"],
        2: ["etl", "spark", "airflow", "dbt", "databricks", "snowflake", "bigquery",
            "redshift", "power bi", "tableau", "looker", "hadoop", "deep learning",
            "nlp", "computer vision", "tensorflow", "pytorch", "pandas", "scikit",
            "jupyter", "data lake", "feature engineering", "a/b test"],
        1: ["sql", "analytics", "pipeline", "statistics", "regression", "kafka",
            "fivetran", "metabase", "superset"],
    },
    "DevOps": {
        3: ["site reliability", "sre", "platform engineer", "devops",
            "infrastructure engineer", "cloud engineer"],
        2: ["kubernetes", "terraform", "ansible", "docker", "helm", "ci/cd",
            "jenkins", "github actions", "gitlab ci", "argocd", "prometheus",
            "grafana", "datadog", "observability", "cloudformation", "pulumi",
            "vault", "istio", "service mesh"],
        1: ["aws", "gcp", "azure", "linux", "nginx", "monitoring"],
    },
    "Frontend": {
        3: ["frontend engineer", "front-end engineer", "front end developer",
            "ui developer", "ui engineer"],
        2: ["react", "next.js", "vue", "nuxt", "angular", "svelte", "tailwind",
            "sass", "webpack", "vite", "storybook", "responsive design",
            "web components", "redux", "zustand"],
        1: ["javascript", "typescript", "html", "css", "dom", "accessibility",
            "a11y", "figma"],
    },
    "Backend": {
        3: ["backend engineer", "back-end engineer", "back end developer",
            "server-side", "api engineer"],
        2: ["microservices", "spring boot", "spring", "django", "flask", "fastapi",
            "express", "nestjs", "rails", "laravel", "graphql", "grpc", "rest api",
            "rabbitmq", "celery", "redis", "elasticsearch", "postgres", "mysql",
            "mongodb"],
        1: ["java", "python", "node", "go", "golang", "ruby", "rust", "c#", ".net",
            "php", "scala"],
    },
    "Mobile": {
        3: ["mobile engineer", "mobile developer", "ios developer",
            "android developer", "ios engineer", "android engineer",
            "react native", "flutter"],
        2: ["swift", "swiftui", "kotlin", "objective-c", "xcode", "android studio",
            "cocoapods", "gradle", "jetpack compose", "expo"],
        1: ["ios", "android", "mobile", "app store", "play store"],
    },
    "Produto": {
        3: ["product manager", "product owner", "product lead",
            "product management", "head of product", "vp product"],
        2: ["roadmap", "stakeholders", "discovery", "okr", "user stories",
            "product strategy", "prioritization"],
        1: ["jira", "backlog", "agile", "scrum", "sprint", "requirements", "kpi"],
    },
    "QA": {
        3: ["qa engineer", "quality assurance", "test engineer", "sdet",
            "test automation", "quality engineer"],
        2: ["selenium", "cypress", "playwright", "appium", "pytest", "jest",
            "test plan", "regression testing", "load testing",
            "performance testing", "manual testing"],
        1: ["testing", "bug"],
    },
    "Design": {
        3: ["ux designer", "ui designer", "product designer", "ux researcher",
            "design system", "interaction designer"],
        2: ["figma", "sketch", "prototyping", "wireframe", "user research",
            "usability", "design tokens"],
        1: ["typography", "color theory", "visual design"],
    },
    "Security": {
        3: ["security engineer", "cybersecurity", "infosec", "penetration test",
            "appsec", "devsecops", "soc analyst"],
        2: ["owasp", "vulnerability", "siem", "threat model", "encryption", "iam",
            "zero trust", "compliance"],
        1: ["firewall", "authentication", "authorization"],
    },
}

# Title evidence per area, searched case-insensitively.
TITLE_PATTERNS = {
    "Dados": r"\b(data\s*(engineer|scientist|analyst)|machine learning|ml engineer|bi analyst|analytics engineer)\b",
    "DevOps": r"\b(devops|sre|site reliability|platform engineer|infrastructure|cloud engineer)\b",
    "Frontend": r"\b(front[\s-]?end|ui\s*(developer|engineer)|react developer|web developer)\b",
    "Backend": r"\b(back[\s-]?end|server[\s-]?side|api (developer|engineer)|software engineer)\b",
    "Mobile": r"\b(mobile|ios|android|react native|flutter)\s*(developer|engineer)?\b",
    "Produto": r"\b(product\s*(manager|owner|lead|director|vp)|head of product)\b",
    "QA": r"\b(qa|quality assurance|sdet|test (engineer|lead|automation))\b",
    "Design": r"\b(ux|ui|product)\s*designer|ux researcher|design (lead|director)\b",
    "Security": r"\b(security|infosec|cybersecurity|appsec|devsecops|soc analyst)\b",
}
TITLE_BOOST = 5
TITLE_WINDOW_CHARS = 300
MIN_AREA_SCORE = 2

# --------------------------------------------------------------------------
# English stop words (the words that can reach the filter, that
# is without apostrophes) and the contractions a word tokeniser splits
# --------------------------------------------------------------------------
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs themselves
what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below
to from up down in out on off over under again further then once here there when
where why how all any both each few more most other some such no nor not only own
same so than too very s t can will just don should now d ll m o re ve y ain aren
couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan shouldn wasn
weren won wouldn
""".split()
CONTRACTIONS = {
    "cannot": "can not",
    "gimme": "gim me",
    "gonna": "gon na",
    "gotta": "got ta",
    "lemme": "lem me",
    "wanna": "wan na",
}

# --------------------------------------------------------------------------
# Sizes of the per-document summaries and of the model
# --------------------------------------------------------------------------
TOP_LEMMAS = 8
TOP_POS = 6
TOP_NOUN_CHUNKS = 8
BASIC_ENTITY_CAP = 6
ADVANCED_ENTITY_CAP = 8
ANNOTATE_BATCH_ROWS = 32
CORPUS_MAX_FEATURES = 5000
MODEL_MAX_FEATURES = 6000
TEST_SIZE = 0.2
SPLIT_SEED = 42
MODEL_MAX_ITER = 2000
TOP_SKILLS = 20
TOP_SENIORITY = 12
TOP_PAIRS = 10

"""Fixed lookup values. Equal results need exactly these words and patterns."""

# Dependency names that say nothing about a technology, lowercase.
NOISE_WORDS = (
    "version", "name", "scripts", "type", "url", "dependencies", "devdependencies",
    "description", "eslint", "build", "main", "license", "types", "typescript",
    "dev", "@types/node", "author", "test", "repository", "start", "lint",
    "default", "keywords", "react-dom", "private", "node", "files", "engines",
    "homepage", "import", "exports", "module", "require", "browser", "directory",
    "bugs", "category", "target", "language", "funding", "access", "publishconfig",
    "publishtoclawhub", "githubusername", "contributors", "email", "openclawversion",
    ".", "./package.json", "format", "check", "typecheck", "preview", "pluginapi", "compat",
)

# Sector -> keywords; a library belongs to every sector one of whose keywords it contains.
SECTOR_SEEDS = {
    "Frontend & UI": (
        "react", "vite", "tailwind", "next", "lucide",
        "recharts", "motion", "vue", "svelte", "shadcn",
    ),
    "Backend & API": (
        "express", "fastapi", "flask", "uvicorn", "pydantic",
        "multer", "supabase", "firebase", "auth", "psycopg2",
    ),
    "Data Science & Database": (
        "pandas", "numpy", "scikit-learn", "torch", "tensorflow",
        "matplotlib", "seaborn", "postgresql", "redis", "mongodb",
    ),
    "Developer Experience & Testing": (
        "vitest", "jest", "prettier", "cypress", "playwright",
        "dotenv", "tsx", "husky", "babel", "webpack",
    ),
}

# Python packaging tools, never counted as a trend.
PACKAGING_TOOLS = ("pip", "setuptools", "wheel")

# The characters Python calls whitespace: as text, and as a Java regex class. Java's \s alone
# misses the separators from U+001C on.
WHITESPACE_CHARACTERS = "".join(
    map(
        chr,
        (
            *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
            *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
        ),
    )
)
WHITESPACE = (
    r"[\s\x1c-\x1f\x85\xa0"
    r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

# (?dm): only \n starts a line, as in Python's MULTILINE.
PYTHON_DEPENDENCY = r"(?dm)^\+([a-zA-Z0-9\-_]+)"
JAVASCRIPT_DEPENDENCY = r"\+" + WHITESPACE + r'*"([^"]+)":'

LEAK_THRESHOLD = 4.5
HIGH_RISK_THRESHOLD = 3.5

"""Fixed values of the two relevance filters: tags, and regular expressions that ignore case."""

# fmt: off
# Competitive programming.
CP_TAGS = (
    "dynamic programming", "dp", "greedy", "divide and conquer", "binary search", "two pointers", "sliding window",
    "sorting", "backtracking", "recursion", "memoization", "brute force", "array", "linked list", "stack", "queue",
    "deque", "heap", "priority queue", "hash map", "hash set", "trie", "segment tree", "fenwick tree", "bit",
    "binary indexed tree", "disjoint set", "union find", "sparse table", "graph", "tree", "bfs", "dfs",
    "shortest path", "dijkstra", "bellman-ford", "floyd-warshall", "minimum spanning tree", "kruskal", "prim",
    "topological sort", "strongly connected components", "tarjan", "kosaraju", "bipartite", "matching",
    "network flow", "max flow", "articulation point", "bridge", "euler path", "hamiltonian", "dag", "number theory",
    "prime", "sieve", "gcd", "lcm", "modular arithmetic", "modular inverse", "euler totient",
    "chinese remainder theorem", "crt", "combinatorics", "permutation", "combination", "binomial coefficient",
    "matrix exponentiation", "fast fourier transform", "fft", "ntt", "probability", "expected value", "game theory",
    "nim", "geometry", "convex hull", "line intersection", "polygon", "computational geometry", "coordinate geometry",
    "string", "kmp", "z-algorithm", "rabin-karp", "suffix array", "suffix automaton", "aho-corasick", "palindrome",
    "manacher", "string matching", "pattern matching", "competitive programming", "codeforces", "atcoder", "leetcode",
    "algorithm", "algorithmic", "contest", "olympiad", "icpc", "ioi", "data structure", "optimization",
    "construction", "counting", "interactive", "output the answer", "modulo", "mod 1e9+7",
)
CP_PATTERNS = (
    r"\bT\s*=\s*int\(input\(\)\)",
    r"for.*in range.*int.*input",
    r"sys\.stdin",
    r"scanf\(",
    r"printf\(",
    r"cin\s*>>",
    r"cout\s*<<",
    r"\bmod\s*=\s*10\*\*9",
    r"\bmod\s*=\s*1e9\+7",
    r"\bMOD\s*=\s*10\*\*9",
    r"1000000007",
    r"998244353",
    r"\bINF\s*=\s*float\('inf'\)",
    r"\bpq\s*=\s*\[\]",
    r"heappush|heappop",
    r"bisect_left|bisect_right",
    r"defaultdict|Counter\(",
    r"adjacency list|adj\[",
    r"dp\[",
    r"\bfib\b|\bfibonacci\b",
    r"prefix sum|suffix sum",
    r"binary search|bisect",
    r"n, m\s*=\s*map|n,m\s*=\s*map",
    r"constraints?:\s*\d",
    r"\d\s*≤\s*[Nn]\s*≤\s*\d",
    r"\d+\s*<=\s*[Nn]\s*<=\s*\d+",
    r"input format|output format",
    r"sample input|sample output",
    r"time limit|memory limit",
    r"queries?|operations?",
)
CP_REJECT_TAGS = (
    "web development", "frontend", "backend", "react", "angular", "vue", "html", "css", "javascript", "typescript",
    "nodejs", "django", "flask", "spring", "rest api", "graphql", "http", "sql", "database", "orm", "docker",
    "kubernetes", "devops", "ci/cd", "deployment", "cloud", "aws", "gcp", "azure", "mobile", "android", "ios",
    "flutter", "react native", "ui", "ux", "design", "documentation", "readme", "tutorial", "blog",
    "machine learning", "deep learning", "neural network", "nlp", "data science", "pandas", "numpy", "matplotlib",
    "scraping", "selenium", "playwright", "game development", "unity", "unreal", "testing", "unit test",
    "integration test", "pytest", "logging", "monitoring", "observability",
)
CP_REJECT_PATTERNS = (
    r"\bimport\s+React\b",
    r"\bimport\s+flask\b",
    r"\bimport\s+django\b",
    r"\bfrom\s+django\b",
    r"\bimport\s+express\b",
    r"\bimport\s+fastapi\b",
    r"<!DOCTYPE html>",
    r"<html",
    r"SELECT\s+\w+\s+FROM\b",
    r"CREATE\s+TABLE\b",
    r"@app\.route",
    r"@router\.",
    r"app\.get\(|app\.post\(",
    r"useEffect|useState\b",
    r"import\s+tensorflow|import\s+torch\b",
    r"import\s+pandas\b",
    r"import\s+sklearn",
    r"\.fit\(|\.predict\(",
    r"docker-compose",
    r"kubernetes|kubectl",
)
CP_TRUSTED = ("taco", "code_contests", "codeforces", "codeforces_cots")

# Software engineering. In SE_PATTERNS a dot matches line ends too.
SE_TAGS = (
    "react", "vue", "angular", "svelte", "nextjs", "nuxtjs", "html", "css", "javascript", "typescript", "webpack",
    "vite", "tailwind", "bootstrap", "redux", "graphql", "rest", "api", "fetch", "ajax", "dom", "django", "flask",
    "fastapi", "express", "nestjs", "spring", "rails", "laravel", "gin", "fiber", "actix", "asp.net", "node.js",
    "nodejs", "python", "java", "go", "rust", "c#", "ruby", "php", "kotlin", "sql", "postgresql", "mysql", "sqlite",
    "mongodb", "redis", "elasticsearch", "cassandra", "dynamodb", "firebase", "supabase", "orm", "prisma",
    "sqlalchemy", "database", "migration", "schema", "query", "index", "docker", "kubernetes", "k8s", "terraform",
    "ansible", "helm", "ci/cd", "github actions", "gitlab ci", "jenkins", "aws", "gcp", "azure", "s3", "ec2",
    "lambda", "serverless", "nginx", "apache", "load balancer", "monitoring", "prometheus", "grafana", "elk",
    "logging", "observability", "android", "ios", "flutter", "react native", "swift", "xcode", "android studio",
    "mobile", "app store", "play store", "microservices", "monolith", "event-driven", "cqrs", "event sourcing",
    "design pattern", "solid", "dry", "clean architecture", "hexagonal", "domain driven design", "ddd", "api gateway",
    "service mesh", "message queue", "kafka", "rabbitmq", "pub/sub", "websocket", "scalability", "availability",
    "reliability", "consistency", "cap theorem", "distributed system", "sharding", "replication", "caching", "cdn",
    "rate limiting", "circuit breaker", "saga pattern", "two-phase commit", "unit test", "integration test",
    "e2e test", "pytest", "jest", "mocha", "cypress", "playwright", "tdd", "bdd", "code review", "refactoring",
    "technical debt", "code quality", "linting", "formatting", "authentication", "authorization", "oauth", "jwt",
    "ssl", "tls", "encryption", "hashing", "xss", "csrf", "sql injection", "owasp", "penetration testing",
    "vulnerability", "security audit", "http", "https", "tcp", "udp", "dns", "grpc", "sse", "proxy", "reverse proxy",
    "firewall", "vpn", "network", "performance", "optimization", "profiling", "latency", "throughput", "bottleneck",
    "memory leak", "garbage collection", "caching strategy", "debugging", "bug", "error", "exception", "stack trace",
    "breakpoint", "root cause", "postmortem", "incident", "software engineering", "software development",
    "programming", "coding", "git", "version control", "agile", "scrum", "sprint", "deployment", "production",
    "staging", "environment", "configuration",
)
SE_PATTERNS = (
    r"\bimport\s+React\b",
    r"\bimport\s+(express|flask|django|fastapi|gin|fiber)\b",
    r"\bfrom\s+(django|flask|fastapi|express|spring)\b",
    r"\bapp\.(get|post|put|delete|patch)\s*\(",
    r"\brouter\.(get|post|put|delete)\s*\(",
    r"<!DOCTYPE html>",
    r"<html",
    r"\bSELECT\s+\w.*?\bFROM\b",
    r"\bCREATE\s+TABLE\b",
    r"\bINSERT\s+INTO\b",
    r"\bUPDATE\s+\w+\s+SET\b",
    r"docker-compose",
    r"FROM\s+\w+:\w+",
    r"kubernetes|kubectl|helm\s+install",
    r"\.github/workflows",
    r"pipeline\s*\{",
    r"\baws\.\w+\(",
    r"boto3\.",
    r"@app\.route",
    r"@router\.",
    r"useEffect|useState|useContext",
    r"\bsetup\.py\b|pyproject\.toml",
    r"package\.json",
    r"npm\s+(install|run|start)",
    r"yarn\s+(add|install|start)",
    r"git\s+(commit|push|pull|clone|merge)",
    r"def\s+test_\w+",
    r"class\s+Test\w+",
    r"@pytest\.",
    r"describe\s*\(",
    r'''it\s*\(\s*['\"]''',
    r"@controller|@service|@injectable",
    r"microservice|api\s+gateway",
    r"redis\.set|redis\.get",
    r"\.find\(\{|\.aggregate\(\[",
    r"async\s+def\s+\w+|await\s+\w+",
    r"try\s*\{.*?catch\s*\(",
    r"JWT|Bearer\s+token",
    r"CORS|cors\(",
)
SE_REJECT_TAGS = (
    "competitive programming", "codeforces", "atcoder", "leetcode", "dynamic programming", "greedy algorithm",
    "binary search", "segment tree", "fenwick tree", "graph theory", "number theory", "olympiad", "icpc", "ioi",
    "contest", "puzzle", "data science", "machine learning", "deep learning", "neural network", "nlp",
    "computer vision", "reinforcement learning",
)
SE_REJECT_PATTERNS = (
    r"1000000007|998244353",
    r"\bMOD\s*=\s*10\*\*9",
    r"T\s*=\s*int\(input\(\)\)",
    r"sys\.stdin\.readline",
    r"cin\s*>>\s*\w+\s*>>\s*\w+",
    r'''scanf\(\s*['\"]%[dls]''',
    r"\bheapq\b.*\bpush\b|bisect_left|bisect_right",
    r"Codeforces|AtCoder|HackerRank|HackerEarth",
    r"import\s+tensorflow|import\s+torch\b",
    r"import\s+sklearn|from\s+sklearn",
    r"\.fit\(.*\)|\.predict\(",
    r"plt\.plot|plt\.show|matplotlib",
    r"import\s+pandas\b",
    r"pd\.DataFrame|pd\.read_csv",
)
SE_TRUSTED = (
    "stack_exchange", "magicoder_oss", "magicoder_evol", "code_feedback", "evol_codealpaca", "glaive_code", "text_to_sql",
    "self_oss_instruct", "commitpackft", "ultrachat",
)

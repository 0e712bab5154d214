"""Settings for the detection engine.

One frozen ``Settings`` object carries every threshold.  Two profiles exist
because the behaviour being rebuilt has two generations: ``legacy`` (batch,
three signals) and ``current`` (live, seven signals).  ``as_of`` replaces
every wall-clock read so results are repeatable.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the behaviour being matched, so they are
# stated plainly and in their natural order.
# ---------------------------------------------------------------------------

# Stop words for the English test (a word counts when found as " w ").
ENGLISH_WORDS = (
    "the", "and", "for", "that", "this", "with",
    "are", "from", "have", "not", "but", "they",
    "was", "his", "her", "you", "can", "will",
    "been", "more", "also", "than", "its", "were",
)

# Suspicious registration names (current profile).
SUSPICIOUS_TLDS = (".xyz", ".top", ".click", ".online", ".site", ".info", ".buzz", ".icu")
SUSPICIOUS_KEYWORDS = (
    "truth", "patriot", "freedom", "liberty", "alert", "insider",
    "expose", "breaking", "real-news", "updates-now", "daily-truth",
    "peoples-voice", "wire", "report", "first-news", "national-alert",
)
# Suspicious keywords of the retrain profile (no "report", seven more).
RETRAIN_KEYWORDS = (
    "truth", "patriot", "freedom", "liberty", "alert", "insider",
    "expose", "breaking", "real-news", "updates-now", "daily-truth",
    "peoples-voice", "wire", "first-news", "national-alert",
    "empire", "activist", "conspiracy", "infowars", "prison",
    "beforeitsnews", "naturaln", "globalresearch",
)

# Sites that carry content from everywhere; never compared.
NOISE_DOMAINS = (
    "archive.is", "archive.today", "archive.org", "web.archive.org",
    "webcache.googleusercontent.com", "cached.google.com",
    "translate.google.com", "amp.google.com",
    "google.com", "bing.com", "yahoo.com", "duckduckgo.com",
    "reddit.com", "twitter.com", "x.com", "facebook.com",
    "linkedin.com", "pinterest.com", "tumblr.com",
    "wikipedia.org", "wikimedia.org",
    "pastebin.com", "hastebin.com",
)

NOISE_AUTHORS = (
    "reuters", "ap", "associated press", "staff writer", "news desk",
    "wire service", "staff reporter", "the editors", "editorial board",
    "admin", "editor", "contributor", "guest writer", "press release",
)

WIRE_SERVICES = (
    "apnews.com", "ap.org", "reuters.com", "afp.com", "bloomberg.com",
    "bbc.com", "bbc.co.uk", "npr.org", "pbs.org", "theguardian.com",
    "nytimes.com", "washingtonpost.com", "wsj.com", "economist.com",
    "ft.com", "cnn.com", "nbcnews.com", "cbsnews.com", "abcnews.go.com",
    "foxnews.com", "usatoday.com", "thehill.com", "politico.com", "axios.com",
)
ESTABLISHED_LOCAL_OUTLETS = (
    "nbcboston.com", "wgbh.org", "wcvb.com", "wbur.org",
    "latimes.com", "laist.com",
    "chicagotribune.com", "wttw.com",
    "dallasnews.com", "kera.org",
    "chron.com", "houstonpublicmedia.org",
    "ajc.com", "wabe.org",
    "sfchronicle.com", "kqed.org",
    "seattletimes.com", "kuow.org",
    "oregonlive.com", "opb.org",
    "startribune.com", "mpr.org",
)
AUTHORITY_DOMAINS = WIRE_SERVICES + ESTABLISHED_LOCAL_OUTLETS

SYNDICATION_MARKERS = (
    "associated press", "ap —", "reuters —", "afp —",
    "copyright ap", "copyright reuters",
    "contributed to this report",
    "wire service report",
    "this story was originally published",
    "republished with permission",
)

NAV_PHRASES = (
    "home", "about us", "contact", "privacy policy", "terms of service",
    "subscribe", "newsletter", "advertise", "cookies",
)

CDN_ASNS = (
    "AS13335", "AS54113", "AS16509", "AS15169", "AS20940",
    "AS209242", "AS22120", "AS14618", "AS8075",
)
CDN_IP_PREFIXES = (
    "104.16.", "104.17.", "104.18.", "104.19.", "104.20.", "104.21.",
    "172.64.", "172.65.", "172.66.", "172.67.", "162.158.", "198.41.",
    "1.1.1.", "1.0.0.",
)
CDN_ORG_KEYWORDS = (
    "cloudflare", "fastly", "amazon", "google", "akamai", "microsoft",
    "azure", "aws", "digitalocean", "linode", "vultr", "rackspace",
    "leaseweb", "ovh", "hetzner", "sucuri", "incapsula",
)

# Registrars exempt from the legacy clustering rule.
CLUSTER_EXEMPT_REGISTRARS = (
    "MarkMonitor", "CSC Corporate Domains",
    "Network Solutions", "GoDaddy", "Namecheap",
    "Google Domains", "Cloudflare", "Amazon",
    "unknown", "",
)
# Bulk registrars of the repair rule (case-insensitive substring).
BULK_REGISTRARS = ("bizcn", "publicdomainregistry", "pdr ltd", "namecheap", "enom", "dynadot")

PARENT_SECOND_LEVEL = ("co", "com", "org", "net", "gov")

ARTICLE_URL_PATTERNS = (
    "/2024/", "/2025/", "/2026/",
    "/news/", "/article/", "/articles/",
    "/story/", "/stories/", "/post/", "/posts/",
    "/blog/", "/p/", "/politics/", "/world/",
    "/opinion/", "/tech/", "/science/",
)
# Byline patterns; group 1 is the name.
BYLINE_PATTERNS = (
    r"[Bb]y\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3})",
    r"[Aa]uthor[:\s]+([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3})",
    r"[Ww]ritten\s+[Bb]y\s+([A-Z][a-z]+(?:\s+[A-Z][a-z]+){1,3})",
)
STRIP_TAGS = ("script", "style", "nav", "footer", "header", "aside", "form", "noscript", "iframe")
LEGACY_STRIP_TAGS = ("script", "style", "nav", "footer", "header", "aside", "form")
STRIP_CLASSES = (
    "menu", "sidebar", "cookie", "banner", "ad-",
    "widget", "newsletter", "related", "social",
    "share", "comment", "breadcrumb", "pagination",
    "tag", "category", "author-bio", "promo",
)

# Fixed verdict wording.
VERDICTS = ("SYNTHETIC", "REVIEW", "ORGANIC")
SIGNAL_COLUMNS = (
    "similarity_flag", "cadence_flagged", "whois_flagged", "hosting_flagged",
    "link_network_flagged", "wayback_flagged", "author_overlap_flagged",
)
SIGNAL_NAMES = (
    "content similarity", "cadence anomaly", "WHOIS age", "shared hosting",
    "insular link network", "Wayback history", "shared author bylines",
)
RISK_COPY = (
    ("SYNTHETIC", "HIGH_RISK", "High Risk - Likely part of a fake network"),
    ("REVIEW", "SUSPICIOUS", "Suspicious - Some warning signs detected"),
    ("ORGANIC", "LOW_RISK", "Looks Legitimate - No warning signs"),
)
PRELIMINARY_REASONS = (
    "Domain was registered very recently",
    "Domain uses a higher-risk TLD commonly seen in low-trust campaigns",
    "Domain name pattern looks promotional or synthetic",
    "WHOIS pattern triggered the registration-risk heuristic",
)
# Stored-node reasons (the last takes the related count) and recent-feed reasons.
STORED_REASONS = (
    "High content similarity was observed with related domains",
    "Domain registration is recent",
    "Publishing cadence appears coordinated",
    "Connected to %d related domain(s) in the network graph",
)
STORED_NONE = "No strong warning signals were found in stored graph features"
RECENT_REASONS = ("high content similarity", "multiple detection signals", "very recent domain registration")
RECENT_NONE = "suspicious network indicators"
# Evidence tiers by raw similarity (>= .85, >= .75, else).
EVIDENCE_TIERS = (
    "Very high — strong indicator of copied or templated content",
    "Moderately high — possible coordination, verify content manually",
    "Low-moderate — likely topic or geographic overlap, not coordination",
)
# Cluster summary sentences; the REVIEW one states that two signals fired.
CLUSTER_TEXT = (
    "High Risk - Likely part of a fake network. %d domain(s) were flagged with converging signals. Confidence: %d%%.",
    "Suspicious - Some warning signs detected. %d domain(s) need a closer look. Two signals fired, so this is "
    "not a confirmed synthetic network yet.",
    "Looks Legitimate - No warning signs were detected. All %d domains currently appear organic.",
)
PRELIMINARY_NONE = "No strong warning signs were found in quick domain-registration heuristics"


@dataclass(frozen=True)
class Settings:
    profile: str = "current"
    as_of: str = "2026-04-08 00:00:00"
    # similarity
    sim_threshold: float = 0.65
    sim_edge_threshold: float = 0.65
    legacy_sim_flag: float = 0.85
    legacy_sim_edge: float = 0.5
    authority_pair_weight: float = 0.50
    authority_mixed_weight: float = 0.75
    authority_pair_mult: float = 1.50
    authority_mixed_mult: float = 1.20
    excerpt_chars: int = 400
    # cadence
    contamination_min: float = 0.1
    contamination_max: float = 0.3
    forest_trees: int = 50
    forest_sample: int = 256
    legacy_contamination: float = 0.1
    legacy_trees: int = 100
    # registration
    young_days: int = 90
    legacy_young_days: int = 365
    whois_daily_limit: int = 15
    # links
    insular_threshold: float = 0.5
    min_links_insular: int = 3
    min_domains_insular: int = 5
    # archive
    wayback_min_snapshots: int = 5
    wayback_recent_days: int = 30
    wayback_spike_ratio: float = 0.5
    wayback_max_rows: int = 500
    # verdict
    synthetic_at: int = 3
    review_at: int = 2
    # cache
    cache_ttl_hours: int = 24
    min_text_len: int = 100
    min_embed_text: int = 50
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)

    @property
    def legacy(self) -> bool:
        return self.profile == "legacy"


CURRENT = Settings()
LEGACY = Settings(profile="legacy", sim_threshold=0.85, sim_edge_threshold=0.5,
                  synthetic_at=2, review_at=1, young_days=365)

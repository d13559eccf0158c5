"""Parameters: weights, thresholds, keyword lists, rule tables, dimensions."""
from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values: must equal the published configuration for equal results ---------------------

WEIGHTS = {
    "relevance": 0.30,
    "novelty": 0.20,
    "impact": 0.30,
    "taiwan_related": 0.10,
    "market_signal": 0.10,
}

HIGH_IMPACT = ["GPT-5", "Gemini", "Claude", "Llama", "benchmark", "開源", "監管", "regulation"]
TAIWAN_RELATED = ["台灣", "taiwan", "TSMC", "國科會", "教育部"]
MARKET_SIGNAL = ["earnings", "股價", "上市", "IPO", "收購", "acquires"]

POLICY_KEYWORDS = [
    "國科會", "教育部", "經濟部", "數位發展部", "NCC", "監管", "補助", "立法院", "原住民族",
    "TWNIC", "TSMC", "台積電", "policy", "regulation", "subsidy", "taiwan",
]

RELEVANCE_KEYWORDS = [
    "ai", "llm", "gpt", "claude", "gemini", "llama", "anthropic", "openai", "agent", "ml ",
    "neural", "transformer", "diffusion", "rag", "embedding", "model",
]

TIER_BONUS = {1: 1.2, 2: 1.0, 3: 0.9, 4: 0.8}
TIER_FETCH_LIMIT = {1: 20, 2: 30, 3: 15, 4: 10}
DEFAULT_FETCH_LIMIT = 20
DEFAULT_CONFIDENCE = 0.7

SECTIONS = [
    ("giants_market", "🏢", "巨頭動向與市場脈動"),
    ("dev_tools_agent", "🛠️", "開發者工具與 AI Agent"),
    ("generative_media", "🎵", "生成式多媒體與創作"),
    ("edu_tech", "📚", "教育科技與應用創新"),
    ("infra_open_source", "🧠", "底層架構與開源模型"),
    ("law_ethics_society", "⚖️", "法律倫理與社會衝擊"),
]
DEFAULT_SECTION = "giants_market"

DEFAULT_PERSPECTIVE = "媒體設計分析"

DEFAULT_TAG = "ai"

STOPWORDS_EN = [
    "the", "and", "for", "with", "from", "this", "that", "are", "was", "have", "has", "but", "you",
    "our", "your", "their", "more", "less", "than", "into", "about", "also", "while", "where",
    "after", "before", "what", "which", "when", "ai", "model", "data", "use", "using", "based",
]
STOPWORDS_ZH = [
    "今天", "我們", "他們", "以及", "可以", "因為", "但是", "現在", "未來", "本週", "目前", "新聞",
    "報導", "表示", "宣布",
]

SOURCES = [
    # id, name, tier, type, url, confidence, enabled
    ("openai_blog", "OpenAI Blog", 1, "rss", "https://openai.com/blog/rss.xml", 0.95, True),
    ("anthropic_news", "Anthropic News", 1, "rss", "https://www.anthropic.com/news/rss.xml", 0.95, True),
    ("google_ai_blog", "Google AI Blog", 1, "rss", "https://blog.google/technology/ai/rss/", 0.9, True),
    ("google_keyword", "Google The Keyword", 1, "rss", "https://blog.google/rss/", 0.85, True),
    ("hf_blog", "Hugging Face Blog", 1, "rss", "https://huggingface.co/blog/feed.xml", 0.85, True),
    ("hacker_news", "Hacker News Front Page", 2, "hn_api",
     "https://hacker-news.firebaseio.com/v0/topstories.json", 0.7, True),
    ("github_trending", "GitHub Trending (AI)", 2, "github_trending",
     "https://github.com/trending?since=daily&spoken_language_code=", 0.7, True),
    ("arxiv_ai", "arXiv cs.AI", 2, "rss", "https://export.arxiv.org/rss/cs.AI", 0.75, True),
    ("papers_with_code", "Papers With Code", 2, "rss", "https://paperswithcode.com/latest.atom", 0.75, False),
    ("edsurge", "EdSurge", 3, "rss", "https://www.edsurge.com/articles_rss", 0.7, True),
    ("nstc_tw", "台灣國科會", 3, "rss", "https://www.nstc.gov.tw/rss", 0.8, True),
    ("yahoo_finance_ai", "Yahoo Finance AI", 4, "rss", "https://finance.yahoo.com/news/rssindex", 0.6, True),
]

WARN_COVERAGE = "section coverage below 80%"
WARN_FEW = "fewer than min articles for publish"
WARN_DROPS = "dedup-heavy fetch — sources may be redundant"
WARN_EMPTY = "no articles in edition"
CARD_ARTICLES, CARD_SOURCES, CARD_IMPACT, CARD_TRENDS = "今日新聞", "來源數", "高影響事件", "趨勢主題"
ALERT_NO_EDITION = "AI generation failed — no edition produced"
ALERT_FEW = "Article count below minimum: "
ALERT_MAIL = "Email delivery failed"
ALERT_PUBLISH = "GitHub publish failed"
ALERT_ERRORS = "Pipeline errors: "
REASON_FROM, REASON_SAMPLE, REASON_JOIN = " articles from ", " in last batch; sample: ", " · "

SCHEMA_VERSION = "2.0"
STORY_LINK = "https://news.ycombinator.com/item?id="
STORY_HEAD = 30  # the first N ids of a story list are looked at
# --- End of fixed values ------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Everything a run can vary."""

    weights: dict = field(default_factory=lambda: dict(WEIGHTS))
    high_impact: list = field(default_factory=lambda: list(HIGH_IMPACT))
    taiwan_related: list = field(default_factory=lambda: list(TAIWAN_RELATED))
    market_signal: list = field(default_factory=lambda: list(MARKET_SIGNAL))
    policy_keywords: list = field(default_factory=lambda: list(POLICY_KEYWORDS))
    policy_boost: float = 0.5
    tier_bonus: dict = field(default_factory=lambda: dict(TIER_BONUS))
    tier_fetch_limit: dict = field(default_factory=lambda: dict(TIER_FETCH_LIMIT))
    final_score_min: float = 7.0
    confidence_min: float = 0.6
    title_threshold: float = 92.0
    vector_threshold: float = 0.88
    vector_days: int = 14
    sections: list = field(default_factory=lambda: list(SECTIONS))
    default_section: str = DEFAULT_SECTION
    # rules in order, the first match wins: (label, keywords) and (keyword, tag)
    section_rules: list = field(default_factory=list)
    perspective_rules: list = field(default_factory=list)
    default_perspective: str = DEFAULT_PERSPECTIVE
    tag_rules: list = field(default_factory=list)
    per_section_min: int = 2
    per_section_max: int = 3
    min_articles: int = 6
    trend_windows: tuple = (7, 14, 30)
    trend_min_count: int = 3
    trend_top: int = 10
    burst_days: int = 14
    burst_baseline_days: int = 90
    burst_terms: int = 120
    burst_min_ratio: float = 3.0
    burst_top: int = 5
    cluster_threshold: float = 0.78
    cluster_days: int = 7
    cluster_min: int = 3
    cluster_top: int = 3
    known_sources: list = field(default_factory=lambda: list(SOURCES))
    editions_listed: int = 30
    editions_front: tuple = (2, 9)  # positions of earlier editions on the front page, the newest being 1
    trends_shown: int = 9
    samples_shown: int = 2
    daily_token_budget: int | None = None
    monthly_token_budget: int | None = None
    permalink_prefix: str = ""

"""Canonical schemas of the engine's tables."""

BEANS = (
    "id string, url string, kind string, source string, source_id string, base_url string, title string, author string, image_url string, summary string, content string, "
    "restricted_content boolean, created timestamp, collected timestamp, embedding array<float>, categories array<string>, sentiments array<string>, regions array<string>, entities array<string>"
)
PUBLISHERS = "id string, source string, base_url string, site_name string, description string, favicon string, rss_feed string, collected timestamp"
CHATTERS = "chatter_url string, url string, bean_id string, source string, platform string, forum string, collected timestamp, likes long, comments long, subscribers long, shares long"
RELATED = "url string, related_url string, collected timestamp"
STATE = "object_type string, id string, state string, ts timestamp, data string"
SIPS = "id string, kind string, source string, url string, base_url string, created timestamp, embedding array<float>, tags array<string>, digest string, ts date"
SOURCES = "id string, base_url string, domain_name string, site_name string, description string, favicon string, rss_feed string, ts date"
RELATIONS = "from_id string, to_id string, relationship string, ts date"
ENTITIES = "regions array<string>, people array<string>, products array<string>, companies array<string>, stock_tickers array<string>"
DIGEST = (
    "briefing string, events array<string>, event_type string, drivers array<string>, impact_level string, confidence string, macro_context string, impacted_domains array<string>, "
    "cross_domain_impacts array<string>, future_outlook array<string>, actions array<string>, activities array<string>, forecast array<string>"
)

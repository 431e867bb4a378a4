"""Controlled vocabularies and routes: fixed values, stated as they are."""

from __future__ import annotations

NA = "n/a"

JURISDICTIONS = [
    "Federal", "Multistate", "Illinois", "Indiana", "Ohio", "Michigan", "Wisconsin", "Missouri", "Texas", "California", "New York", "Pennsylvania", "Tennessee", "Georgia",
    "North Carolina", "South Carolina", "Kentucky", "Alabama", "Canada", "Mexico", "Brazil", "Argentina", "United Kingdom", "Ireland", "Netherlands", "Belgium", "Germany", "France",
    "Italy", "Spain", "Poland", "Czech Republic", "Switzerland", "Sweden", "China", "India", "Japan", "South Korea", "Australia", "OECD", "European Union", "Multinational", "International",
]
TOPICS = [
    "Nexus", "Apportionment", "State Income Tax", "Sales and Use Tax", "Property Tax", "Unclaimed Property", "Federal Income Tax", "Tax Depreciation", "Tax Credits and Incentives",
    "Research and Development Credit", "Interest Deductibility", "Net Operating Losses", "Transfer Pricing", "Foreign Tax Credit", "Permanent Establishment", "Subpart F and GILTI",
    "Withholding", "Treaty Benefits", "Customs and Duties", "VAT and GST", "Pillar Two", "Equity Compensation", "Employment Tax", "Payroll Tax", "Expatriate and Mobility",
    "Employee Benefits", "Entity Structuring", "Mergers and Acquisitions", "Restructuring", "Intercompany Financing", "Tax Provision", "Tax Compliance", "Audit Defense", "Indirect Tax", "Other",
]
#: From the most to the least authoritative.
AUTHORITY_LEVELS = [
    "Statute", "Regulation", "IRS Publication", "Federal Guidance", "State Guidance", "Foreign Tax Authority Guidance", "Treaty", "Case Law", "Legal Opinion", "External Tax Research",
    "Internal Tax Research", "Internal Memo", "Internal Email",
]
DOCUMENT_TYPES = {
    ".pdf": "pdf", ".docx": "docx", ".pptx": "pptx", ".xlsx": "xlsx", ".msg": "email", ".eml": "email", ".html": "html", ".htm": "html", ".md": "markdown",
    ".txt": "text", ".log": "text", ".json": "json", ".csv": "csv", ".tsv": "csv",
}
SOURCE_TYPES = {
    ".msg": "Email Thread", ".eml": "Email Thread", ".pdf": "Tax Memo", ".docx": "Tax Memo", ".xlsx": "Spreadsheet", ".csv": "Spreadsheet", ".tsv": "Spreadsheet", ".pptx": "Presentation",
}
HEADER_LABELS = ["from", "sent", "date", "to", "cc", "bcc", "subject", "importance", "attachments", "reply-to"]
STATES = (
    "Alabama|Alaska|Arizona|Arkansas|California|Colorado|Connecticut|Delaware|Florida|Georgia|Hawaii|Idaho|Illinois|Indiana|Iowa|Kansas|Kentucky|Louisiana|Maine|Maryland|Massachusetts|"
    "Michigan|Minnesota|Mississippi|Missouri|Montana|Nebraska|Nevada|New Hampshire|New Jersey|New Mexico|New York|North Carolina|North Dakota|Ohio|Oklahoma|Oregon|Pennsylvania|"
    "Rhode Island|South Carolina|South Dakota|Tennessee|Texas|Utah|Vermont|Virginia|Washington|West Virginia|Wisconsin|Wyoming"
)
STREET_WORDS = "street|st|avenue|ave|boulevard|blvd|road|rd|drive|dr|lane|ln|way|court|ct|place|pl|parkway|pkwy|highway|hwy|suite|ste|floor|fl|plaza|tower|centre|center"
PHONE_TOKEN, ADDRESS_TOKEN, EMAIL_TOKEN, DISCLAIMER_TOKEN = "[phone removed]", "[address removed]", "[email removed]", "[disclaimer removed]"

#: What a filter may name, what only boosts, what must be there on write, and what is counted by value.
FILTERABLE = [
    "source_id", "source_file", "thread_id", "message_id", "sent_date", "tax_topic", "subtopic", "entities", "business_units", "jurisdictions", "tax_concepts", "evidence_type", "semantic_state",
]
BOOST_ONLY = ["jurisdictions"]
REQUIRED_ON_WRITE = ["chunk_id", "source_id", "source_file", "content", "content_vector"]
FACETS = ["jurisdiction", "tax_topic", "authority_level", "source_type", "legal_entity", "business_unit", "scenario_id"]
#: The fields of a chunk in the index: type, and what can be done with it (k key, s searched, f filtered, c counted as a facet, o ordered by).
INDEX_FIELDS = {
    "chunk_id": ("string", "kf"), "document_id": ("string", "fc"), "chunk_number": ("int", "fo"), "total_chunks": ("int", "f"), "content": ("string", "s"), "content_vector": ("array<float>", "s"),
    "scenario_id": ("string", "sfc"), "scenario_ids": ("array<string>", "sfc"), "source_id": ("string", "f"), "source_file": ("string", "sfc"), "source_type": ("string", "sfc"), "source_date": ("string", "fo"),
    "author": ("string", "sfc"), "page_number": ("int", "fo"), "tax_topic": ("string", "sfc"), "jurisdiction": ("string", "sfc"), "tax_year_or_effective_period": ("string", "sfc"), "authority_level": ("string", "sfc"),
    "legal_entity": ("string", "sfc"), "business_unit": ("string", "sfc"), "thread_subject": ("string", "sfc"), "message_date": ("string", "fo"), "message_index": ("int", "fo"), "validity_status": ("string", "fc"),
    "current_or_superseded": ("string", "fc"), "access_classification": ("string", "fc"), "citation": ("string", "f"), "token_count": ("int", "fo"), "chunk_strategy": ("string", "fc"), "chunk_timestamp": ("string", "fo"),
}
#: What models call some entries of the closed lists; looked for in this order, anywhere in an answer.
JURISDICTION_ALIASES = {
    "the netherlands": "Netherlands", "holland": "Netherlands", "nl": "Netherlands", "uk": "United Kingdom", "great britain": "United Kingdom", "usa": "Federal", "united states": "Federal",
    "us federal": "Federal", "prc": "China", "people's republic of china": "China", "korea": "South Korea", "eu": "European Union",
}

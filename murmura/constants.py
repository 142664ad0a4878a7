"""Fixed values of the engine. They are data, not logic; callers may pass their own."""

from __future__ import annotations

UNKNOWN = "INCONCLUSIVO"


# Limits of a pain text and of the pains of one feedback.
MIN_PAIN_CHARS = 10
MAX_PAIN_CHARS = 350
MAX_PAINS_PER_FEEDBACK = 7

# Confidence gates: create a canonical, enhance the text, route, leave early.
CREATE_CONFIDENCE = 0.6
ENHANCE_CONFIDENCE = 0.7
ROUTE_CONFIDENCE = 0.5
EXIT_CONFIDENCE = 0.3

# First match thresholds of the three tiers, and uses between consolidations.
INITIAL_THRESHOLDS = {"trio": 0.75, "pair": 0.70, "semantic": 0.65, "consolidation": 3}

# Tier number, name, factor on the similarity.
TIERS = ((1, "trio", 1.0), (2, "pair", 0.95), (3, "semantic", 0.90))

# Factor by the method that scored the pair.
METHOD_FACTORS = {"embedding_plus_llm": 1.05, "embeddings_only": 1.02}

# Weights of the textual score.
TEXT_WEIGHTS = {"sequence": 0.4, "jaccard": 0.3, "containment": 0.2, "order": 0.1}

# Accented letters folded by text normalisation.
ACCENTED = "áàãâäéêëèíîïìóôõöòúüûùçñ"
FOLDED = "aaaaaeeeeiiiiooooouuuucn"

# Every character that counts as white space.
WHITESPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]+"
#: As WHITESPACE, without the single blanks that are as they should be.
UNEVEN_SPACE = WHITESPACE[:-2] + "&&[^ ]]" + WHITESPACE[:-1] + "*| " + WHITESPACE

# Words that mark a text as belonging to the domain. Brand words are added by the caller.
DOMAIN_KEYWORDS = ("app", "sistema", "banco", "conta", "cartão")

# Seed taxonomy (category, definition, examples, confidence).
SEED_TAXONOMY = (
    ("TECNOLOGIA", "Problemas técnicos que impedem funcionamento normal",
     ["app trava", "sistema offline", "erro de conexão"], 1.0),
    ("EXPERIENCIA", "Dificuldades de usabilidade e jornada do usuário",
     ["interface confusa", "processo complexo", "difícil encontrar"], 1.0),
    ("NEGOCIO", "Questões comerciais, taxas e condições",
     ["taxa alta", "limite baixo", "condições ruins"], 1.0),
    ("COMUNICACAO", "Problemas de clareza e transparência",
     ["não explicaram", "falta informação", "comunicação confusa"], 1.0),
    ("ATENDIMENTO", "Qualidade do relacionamento e suporte",
     ["atendente rude", "demora no atendimento", "mal atendido"], 1.0),
    ("MARCA", "Percepções sobre confiança e reputação",
     ["perda de confiança", "imagem ruim", "valores questionáveis"], 1.0),
)

# Context terms of the product families.
FAMILY_TERMS = {
    "Canais": ["interação", "navegação", "usabilidade", "acesso", "interface digital"],
    "Meios de Pagamento": ["transferências", "pagamentos", "transações", "débitos", "créditos"],
    "Crédito": ["financiamentos", "empréstimos", "limites", "juros", "parcelas"],
    "Conta Corrente": ["saldos", "extratos", "movimentações", "tarifas básicas"],
    "Investimentos": ["aplicações", "rendimentos", "cdb", "fundos", "rentabilidade"],
    "Cartões": ["compras", "desbloqueios", "faturas", "limites", "bandeiras"],
    "Seguros": ["coberturas", "sinistros", "prêmios", "proteções"],
    "Consórcios": ["contemplações", "parcelas", "grupos", "sorteios"],
}

# Synonyms of products. A caller with a branded product name passes its own table.
PRODUCT_TERMS = {
    "Aplicativo": ["app", "aplicativo", "móvel", "celular", "smartphone"],
    "WhatsApp": ["whats", "zap", "whatsapp", "chat", "conversa"],
    "Internet Banking": ["site", "internet", "web", "online", "navegador"],
    "PIX": ["pix", "pagamento instantâneo", "transferência rápida"],
    "TED/DOC": ["ted", "doc", "transferência bancária", "entre bancos"],
    "Cartões": ["cartão", "cartão de crédito", "cartão de débito", "débito", "crédito"],
}

# Catalogue used when the catalogue table cannot be read.
DEFAULT_CATALOG = {
    "Canais": ["Aplicativo", "WhatsApp", "Internet Banking"],
    "Meios de Pagamento": ["PIX", "Cartões", "TED/DOC"],
    "Conta Corrente": ["Conta Corrente", "Conta Poupança"],
}

# Words that mark a sentence as telling of a problem (default cue lexicon of the extraction).
PROBLEM_CUES = (
    "não", "nunca", "erro", "erros", "falha", "falhas", "problema", "problemas", "dificuldade", "difícil",
    "demora", "demorou", "lento", "lentidão", "trava", "travou", "travando", "alta", "alto", "caro", "cara",
    "ruim", "péssimo", "confuso", "confusa", "falta", "faltou", "perda", "perdi", "baixo", "rude", "offline",
    "redução", "bloqueado", "impossível", "reclamação",
)

"""Vocabularies, patterns and labels that results must agree on.

Nothing here is logic.  Patterns are Java regular expressions applied to text that has already been folded the
way the using operator says.
"""

# --- fixed values: unknown markers and places -------------------------------------------------------------------
UNKNOWN_MARKET = "Não informado"
BRAZIL_NAMES = ("brazil", "brasil")
BRAZIL_CODES = ("br", "brasil", "brazil")
REMOTE_CITY_NAMES = ("br", "brasil", "brazil", "remoto", "remote", "home office")
BRAZIL_COUNTRY_CODES = ("BR", "BRA", "BRASIL", "BRAZIL")
BRAZIL_PLACES = (
    r"(?iuU)\b(?:brasil|brazil|s[aã]o paulo|rio de janeiro|belo horizonte|bras[ií]lia|"
    r"curitiba|porto alegre|recife|fortaleza|salvador|florian[oó]polis|campinas|"
    r"goi[aâ]nia|vit[oó]ria|jo[aã]o pessoa|manaus|bel[eé]m|natal|macei[oó]|"
    r"aracaju|cuiab[aá]|campo grande|joinville|uberl[aâ]ndia)\b"
)
BRAZIL_STATE_CODES = (
    "AC", "AL", "AP", "AM", "BA", "CE", "DF", "ES", "GO", "MA", "MT", "MS", "MG", "PA", "PB", "PR",
    "PE", "PI", "RJ", "RN", "RS", "RO", "RR", "SC", "SP", "SE", "TO",
)
MARKET_BRAZIL_WORDS = (
    "bras", "brazil", "são paulo", "sao paulo", "rio de janeiro", "belo horizonte", "curitiba", "porto alegre",
)
MARKET_REMOTE_WORDS = ("remote", "anywhere", "distributed")
GENERIC_CITY_WORDS = (
    "anywhere", "br", "brasil", "brazil", "global", "hybrid", "hibrido", "nao informada", "presencial", "remote",
    "remoto", "united states", "usa", "worldwide",
)
LOCATION_ACCENTS = {"Sao Paulo": "São Paulo", "Vitoria": "Vitória", "Brasilia": "Brasília", "Goiania": "Goiânia"}
MULTIPLE_LOCATION_LABELS = (
    "multiple locations", "multiple location", "múltiplas localidades", "multiplas localidades",
)

# --- fixed values: work model -----------------------------------------------------------------------------------
REMOTE_WORDS = ("remote", "remoto", "anywhere", "home office", "home-office")
HYBRID_WORDS = ("hybrid", "híbrido", "hibrido")
ON_SITE_WORDS = ("on-site", "onsite", "presencial", "in office", "in-office")
WORKPLACE_PREFIX = r"(?iuU)^\s*(?:remote|remoto|hybrid|h[ií]brido|on[- ]?site|presencial)\s*[,;/|–—-]+\s*"

# --- fixed values: equivalence key ------------------------------------------------------------------------------
EQUIVALENCE_STOP = (
    r"\b(pleno|senior|junior|especialista|analista|estagi\w*|trainee|aprendiz|"
    r"remoto|remote|hibrido|presencial|home\s*office|jr|sr|pl|i{1,3}|\d+)\b"
)

# --- fixed values: seniority (lowest to highest; the highest match wins) -------------------------------------------
SENIORITY_PATTERNS = (
    ("Estágio", r"estagi|intern(ship)?|\bstage\b"),
    ("Trainee/Aprendiz", r"trainee|aprendiz"),
    ("Júnior/Assistente", r"junior|\bjr\b|entry[- ]?level|assistente|auxiliar"),
    ("Pleno", r"pleno|\bpl\b|mid[- ]?level|\bmid\b|\bii\b"),
    ("Sênior/Especialista", r"senior|\bsr\b|especialista|specialist|staff|principal|\biii\b"),
    ("Liderança", r"coordenador|supervisor|gerente|manager|\blead\b|head|diretor|director|\bvp\b|chefe"),
)
STRUCTURED_LEVELS = {
    "internship": "Estágio",
    "entry level": "Júnior/Assistente",
    "mid level": "Pleno",
    "senior level": "Sênior/Especialista",
    "management": "Liderança",
    "estagio": "Estágio",
    "trainee": "Trainee/Aprendiz",
    "aprendiz": "Trainee/Aprendiz",
    "junior/assistente": "Júnior/Assistente",
    "junior": "Júnior/Assistente",
    "entry": "Júnior/Assistente",
    "assistent": "Júnior/Assistente",
    "pleno": "Pleno",
    "mid": "Pleno",
    "senior/especialista": "Sênior/Especialista",
    "senior": "Sênior/Especialista",
    "lideranca": "Liderança",
    "coordinator": "Liderança",
    "manager": "Liderança",
    "director": "Liderança",
    "executive": "Liderança",
    "supervisao/coordenacao": "Liderança",
    "gerencial e executivos": "Liderança",
}

# --- fixed values: area (earlier area wins ties) ------------------------------------------------------------------
AREA_PATTERNS = {
    "Dados, BI e IA": (
        r"analista de dados", r"cientista de dados", r"data analyst", r"data scientist",
        r"data engineer", r"engenheiro de dados", r"business intelligence", r"power bi",
        r"analytics", r"machine learning", r"inteligencia artificial", r"\bia\b", r"\bai\b",
        r"\betl\b", r"\bsql\b", r"\bdados\b", r"\bdata\b", r"big data", r"llm",
    ),
    "Suporte, Atendimento e CS": (
        r"customer success", r"customer support", r"customer experience", r"technical support",
        r"suporte", r"atendimento", r"service desk", r"help ?desk", r"implantacao",
        r"implementation", r"sustentacao", r"application support", r"production support",
    ),
    "TI e Desenvolvimento": (
        r"desenvolvedor", r"developer", r"software engineer", r"engenheiro de software",
        r"backend", r"front-?end", r"full ?stack", r"programador", r"devops", r"\bsre\b",
        r"\bqa\b", r"quality assurance", r"mobile", r"android", r"\bios\b", r"\bjava\b",
        r"python", r"react", r"node", r"\.net", r"cloud", r"infraestrutura", r"cyber",
        r"seguranca da informacao", r"salesforce", r"sap", r"rpa",
    ),
    "Produto e Projetos": (
        r"product manager", r"gerente de produto", r"product owner", r"\bproduto\b",
        r"project manager", r"gerente de projetos", r"\bpmo\b", r"scrum", r"agile",
        r"business analyst", r"analista de negocios",
    ),
    "Design": (r"designer", r"\bux\b", r"\bui\b", r"ux/ui", r"user experience", r"design"),
    "Marketing e Comunicação": (
        r"marketing", r"growth", r"\bseo\b", r"midia", r"conteudo", r"content",
        r"social media", r"brand", r"comunicacao", r"publicidade", r"copywriter", r"\bcrm\b",
    ),
    "Comercial e Vendas": (
        r"vendas", r"\bsales\b", r"comercial", r"\bsdr\b", r"\bbdr\b",
        r"account executive", r"business development", r"pre-vendas", r"representante", r"closer",
    ),
    "Financeiro e Contábil": (
        r"financeiro", r"finance", r"contabil", r"controladoria", r"accounting", r"fp&a",
        r"tesouraria", r"fiscal", r"auditor", r"cobranca", r"credito", r"billing",
    ),
    "Operações e Logística": (
        r"operacoes", r"operations", r"logistica", r"supply", r"\bops\b", r"processos",
        r"\bpcp\b", r"producao", r"administrativ", r"back ?office", r"compras", r"procurement",
    ),
    "RH e Pessoas": (
        r"recursos humanos", r"\brh\b", r"people", r"talent", r"recrut", r"human resources",
        r"departamento pessoal", r"remuneracao", r"beneficios",
    ),
    "Jurídico e Compliance": (r"juridic", r"\blegal\b", r"advogad", r"compliance", r"lgpd", r"contratos"),
    "Engenharia e Indústria": (
        r"engenheiro", r"engenheira", r"engenharia", r"manutencao", r"industrial", r"civil",
        r"eletric", r"mecanic", r"obra", r"tecnico de campo",
    ),
    "Saúde": (r"medic", r"enferm", r"psicolog", r"nutric", r"farmac", r"saude", r"clinica", r"terapeut"),
    "Educação": (
        r"professor", r"educacao", r"pedagog", r"instrutor", r"tutor", r"ensino", r"escola", r"academico",
    ),
}
AREA_OTHER = "Outros"
STRUCTURED_CATEGORIES = {
    "data": "Dados, BI e IA",
    "data science": "Dados, BI e IA",
    "analytics": "Dados, BI e IA",
    "dados, bi e ia": "Dados, BI e IA",
    "software development": "TI e Desenvolvimento",
    "development": "TI e Desenvolvimento",
    "engineering": "TI e Desenvolvimento",
    "devops and sysadmin": "TI e Desenvolvimento",
    "system administration": "TI e Desenvolvimento",
    "qa": "TI e Desenvolvimento",
    "ti e desenvolvimento": "TI e Desenvolvimento",
    "product": "Produto e Projetos",
    "produto e projetos": "Produto e Projetos",
    "design": "Design",
    "marketing": "Marketing e Comunicação",
    "marketing e comunicacao": "Marketing e Comunicação",
    "sales": "Comercial e Vendas",
    "sales and marketing": "Comercial e Vendas",
    "vendas e comercial": "Comercial e Vendas",
    "comercial e vendas": "Comercial e Vendas",
    "finance": "Financeiro e Contábil",
    "finance and legal": "Financeiro e Contábil",
    "financeiro e contabil": "Financeiro e Contábil",
    "human resources": "RH e Pessoas",
    "hr": "RH e Pessoas",
    "rh e recrutamento": "RH e Pessoas",
    "customer service": "Suporte, Atendimento e CS",
    "customer support": "Suporte, Atendimento e CS",
    "suporte, atendimento e cs": "Suporte, Atendimento e CS",
    "operations": "Operações e Logística",
    "operacoes e administrativo": "Operações e Logística",
    "juridico e compliance": "Jurídico e Compliance",
    "engenharia e industria": "Engenharia e Indústria",
    "saude": "Saúde",
    "educacao": "Educação",
}

# --- fixed values: staging classifier (first match wins; applied to folded, word-squeezed titles) --------------------
STAGING_CATEGORIES = (
    ("Dados, BI e IA", r"\b(data|dados|analytics|bi|business intelligence|cientista|machine learning|ml|artificial intelligence|inteligencia artificial|ia|ai|genai|llm|etl|databricks)\b"),
    ("Suporte, Atendimento e CS", r"\b(suporte|support|service desk|help desk|atendimento|customer success|customer experience|cx|sac|implantacao|implementation)\b"),
    ("Produto e Projetos", r"\b(produto|product|product owner|product manager|projetos|project|pmo|scrum|agile|business analyst|analista de negocios)\b"),
    ("TI e Desenvolvimento", r"\b(desenvolvedor|desenvolvedora|developer|software|programador|engenheiro de software|arquiteto|devops|cloud|infraestrutura|cybersecurity|seguranca da informacao|sap|salesforce|qa|quality assurance|automacao|rpa|sre|backend|frontend|fullstack)\b"),
    ("Vendas e Comercial", r"\b(vendas|sales|comercial|account executive|executivo de contas|sdr|bdr|pre vendas|inside sales|closer|key account)\b"),
    ("Marketing e Comunicação", r"\b(marketing|growth|conteudo|content|social media|comunicacao|copywriter|seo|midia|designer|design|brand|crm)\b"),
    ("RH e Recrutamento", r"\b(recursos humanos|rh|people|gente|talent|recrut|departamento pessoal|dp|remuneracao|beneficios)\b"),
    ("Financeiro e Contábil", r"\b(financeiro|finance|contabil|contabilidade|fiscal|tesouraria|controladoria|billing|cobranca|credito|risco)\b"),
    ("Jurídico e Compliance", r"\b(juridic|legal|advogad|compliance|privacidade|lgpd|contratos)\b"),
    ("Operações e Administrativo", r"\b(operacoes|operations|administrativ|backoffice|back office|logistica|supply|compras|procurement|processos|qualidade)\b"),
    ("Engenharia e Indústria", r"\b(engenheiro|engenheira|engenharia|manutencao|producao|industrial|civil|eletric|mecanic|obra|tecnico de campo)\b"),
    ("Saúde", r"\b(medic|enferm|psicolog|nutric|farmac|saude|clinica|terapeut)\b"),
    ("Educação", r"\b(professor|educacao|pedagog|instrutor|tutor|ensino|escola|academico)\b"),
)
STAGING_SENIORITY = (
    ("Estágio", r"\b(estagio|estagiario|internship|intern)\b"),
    ("Trainee/Aprendiz", r"\b(trainee|aprendiz)\b"),
    ("Liderança", r"\b(head|diretor|diretora|gerente|manager|coordenador|coordenadora|lead|lider|supervisor|supervisora)\b"),
    ("Sênior/Especialista", r"\b(senior|sr|especialista|specialist|staff|principal)\b"),
    ("Pleno", r"\b(pleno|pl|mid|mid level)\b"),
    ("Júnior/Assistente", r"\b(junior|jr|assistente|auxiliar)\b"),
)
STAGING_SENIORITY_OTHER = "Não informado"
LANGUAGE_MENTION = r"\b(ingles|english)\b"
LANGUAGE_LEVELS = (
    ("Avançado/fluente", 45, "fluente|avancado|advanced|fluent|c1|c2"),
    ("Intermediário", 45, "intermediario|intermediate|b1|b2"),
    ("Básico", 45, "basico|basic|a1|a2"),
    ("Diferencial", 60, "diferencial|desejavel|nice to have"),
)
LANGUAGE_ABSENT, LANGUAGE_PLAIN = "Não identificado", "Mencionado"
STAGING_WORKPLACE = (
    ("Remoto", r"\b(remote|remoto|home office|teletrabalho)\b"),
    ("Híbrido", r"\b(hybrid|hibrid)\b"),
    ("Presencial", r"\b(on site|onsite|on-site|presencial|office)\b"),
)
STAGING_WORKPLACE_OTHER = "Não informada"
MODALITY_CUES = "modelo|regime|modalidade|atuacao|trabalho"
MODALITY_IN_TEXT = (
    ("Híbrido", "hybrid|hibrid"),
    ("Presencial", "on site|onsite|presencial"),
    ("Remoto", "remote|remoto|home office|teletrabalho"),
)
MODALITY_TEXT_CHARS = 12000
REMOTE_ELIGIBLE_ANYWHERE = r"^(br|brasil|brazil|remot|remote|home office|anywhere|global)$"
ALERT_NO_MODALITY = "A modalidade não foi informada pela plataforma"
ALERT_TITLE = "O título indica %s, mas a plataforma classifica como %s"
ALERT_TEXT = "A descrição pode indicar modalidade %s"
ALERT_PLACE = "Confirme a elegibilidade para: %s"
ALERT_NO_DETAIL = "Os detalhes não foram recuperados nesta atualização"
DEMO_TENANTS = ("demo",)
INFRA_HOSTS = (
    "www", "api", "auth", "app", "status", "mcp", "mcp-dev", "inhub", "login",
    "admin", "inhire-admin", "saml-setup", "sso-setup", "preview", "senior",
    "files", "portal", "board", "people", "new", "novo", "conteudo", "docs",
    "email", "lp", "hub", "webinar", "analytics", "analytics-ss",
)

# --- fixed values: HTML entities of the staging decoder ----------------------------------------------------------------
STAGING_ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ",
    "aacute": "á", "agrave": "à", "acirc": "â", "atilde": "ã", "auml": "ä",
    "eacute": "é", "ecirc": "ê", "euml": "ë", "iacute": "í", "oacute": "ó",
    "ocirc": "ô", "otilde": "õ", "uacute": "ú", "ccedil": "ç",
    "Aacute": "Á", "Agrave": "À", "Acirc": "Â", "Atilde": "Ã",
    "Eacute": "É", "Ecirc": "Ê", "Iacute": "Í", "Oacute": "Ó",
    "Ocirc": "Ô", "Otilde": "Õ", "Uacute": "Ú", "Ccedil": "Ç",
}

# --- fixed values: display labels ---------------------------------------------------------------------------------------
SOURCE_LABELS = {
    "inhire": "InHire",
    "empregare": "Empregare",
    "gupy": "Gupy",
    "solides": "Sólides",
    "geekhunter": "GeekHunter",
    "stone": "Stone",
    "ifood": "iFood",
    "picpay": "PicPay",
    "bancooriginal": "Banco Original",
    "braskem": "Braskem",
    "gmfinancial": "GM Financial",
    "dell": "Dell Technologies",
    "arcelormittal": "ArcelorMittal",
    "grupomateus": "Grupo Mateus",
    "autozone": "AutoZone",
    "nov": "NOV",
    "arcorbrasil": "Arcor Brasil",
    "themuse": "The Muse",
    "remotive": "Remotive",
    "jobicy": "Jobicy",
    "remoteok": "Remote OK",
    "himalayas": "Himalayas",
    "workingnomads": "Working Nomads",
    "arbeitnow": "Arbeitnow",
    "weworkremotely": "We Work Remotely",
    "greenhouse": "Greenhouse",
    "lever": "Lever",
    "ashby": "Ashby",
}
SOURCE_LABEL_BLANK = "Portal não informado"
MARKET_LABELS = {"BR": "Brasil", "Global remote": "Global remoto"}
COMPANY_BLANK, PLACE_BLANK = "Empresa não informada", "Local não informado"
COMPANY_CONFIDENTIAL = "Empresa confidencial"
CONFIDENTIAL_SLUGS = ("confidential", "empresa-confidencial")
CONTRACT_FACET = (("CLT", "CLT"), ("CNPJ", "PJ"), ("Cooperado", "Cooperado"))
CSV_HEADERS = (
    "Cargo", "Empresa", "Portal", "Área", "Senioridade", "Modalidade", "Mercado", "Local", "Contrato", "PcD",
    "Seleção às cegas", "Salário", "Publicada em", "Vista em", "Link",
)

# --- fixed values: contract keywords ------------------------------------------------------------------------------------
CARD_CONTRACTS = (
    ("CLT", r"(?iu)\bclt\b|efetivo\s*[–-]\s*clt"),
    ("PJ", r"(?iu)\bpj\b|prestador(?:a)? de servi[cç]os"),
    ("Cooperado", r"(?iu)\bcooperad[oa]\b"),
    ("Estágio", r"(?iu)\best[aá]gio\b"),
    ("Jovem Aprendiz", r"(?iu)\bjovem aprendiz\b"),
    ("Temporário", r"(?iu)\btempor[aá]ri[oa]\b"),
    ("Autônomo", r"(?iu)\baut[oô]nom[oa]\b"),
)
REGIME_CONTRACTS = (
    ("CLT", r"(?iu)\bclt\b"),
    ("PJ", r"(?iu)\bpj\b|pessoa jur[ií]dica"),
    ("Cooperado", r"(?iu)cooperad"),
    ("Freelancer", r"(?iu)freelanc"),
    ("Temporário", r"(?iu)tempor[aá]ri"),
    ("Estágio", r"(?iu)est[aá]gio"),
    ("Aprendiz", r"(?iu)aprendiz"),
)
CARD_CONTRACT_LINE = r"(?iu)^(?:CLT|PJ|CLT ou PJ|Estágio|Temporário)$"
METADATA_CONTRACT_NAMES = ("tipo de contrato", "employment type", "contract type")
METADATA_KEYWORD_NAMES = ("keywords", "palavras-chave")

# --- fixed values: inclusion flags --------------------------------------------------------------------------------------
PCD_TEXT = r"(?iuU)\bpcd\b|pessoa(?:s)?\s+com\s+defici"
PCD_TEXT_AFFIRMATIVE = PCD_TEXT + r"|vaga\s+(?:afirmativa|exclusiva).{0,40}defici"
PCD_TEXT_SHORT = r"(?iuU)\b(?:pcd|pessoa com defici)"

# --- fixed values: Portuguese month names -------------------------------------------------------------------------------
MONTHS = {
    "jan": 1, "fev": 2, "mar": 3, "abr": 4, "mai": 5, "jun": 6,
    "jul": 7, "ago": 8, "set": 9, "out": 10, "nov": 11, "dez": 12,
}

# --- fixed values: listing-card lines ------------------------------------------------------------------------------------
CARD_DATE_LINE = (
    r"(?iu)^(?:hoje|ontem|h[aá]\s+(\d+)\s+dias?|"
    r"(\d{1,2})\s+(jan|fev|mar|abr|mai|jun|jul|ago|set|out|nov|dez)(?:\s+(\d{4}))?)$"
)
CARD_DISTANCE_LINE = r"(?iu)^(.+?)\s+-\s+([A-Z]{2}),\s*\d+(?:[,.]\d+)?\s*Km de você\.?$"
CARD_PLACE_LINE = r"(?iu)^(.+?)\s+-\s+([A-Z]{2})$"
CARD_RATING_LINE = r"^\d(?:[,.]\d)?$"
CARD_SALARY_LINE = r"(?iu)^(?:R\$|A combinar\b)"
CARD_COUNTRY_LINES = ("todo brasil", "brasil")
CARD_NOT_CITY = ("home office", "remoto", "remota", "híbrido", "hibrido", "presencial")
CARD_NOT_COMPANY = (
    "nova", "contratação urgente", "home office", "remoto", "vagas semelhantes", "candidatar-me",
    "candidatura enviada",
)
CARD_NOT_TITLE = (
    "nova", "contratação urgente", "home office", "remoto", "remota", "híbrido", "hibrido", "presencial",
)
CARD_NOT_TEXT = ("vagas semelhantes", "candidatar-me", "candidatura enviada")
CARD_REMOTE = r"(?iu)\b(?:home\s*-?\s*office|remot[oa])\b"
CARD_HYBRID = r"(?iu)\bh[ií]brid[oa]\b"
CARD_ON_SITE = r"(?iu)\b(?:presencial|on[ -]?site)\b"

# --- fixed values: requirement extraction ---------------------------------------------------------------------------------
MANDATORY_MARKERS = (
    "requisitos e qualificacoes", "requisitos", "qualificacoes", "requirements", "must have", "must-have",
    "voce precisa ter", "para se juntar", "esperamos que voce tenha", "o que buscamos", "perfil desejado",
    "requisitos obrigatorios", "obrigatorio",
)
PREFERRED_MARKERS = (
    "diferenciais", "diferencial", "sera um diferencial", "seria muito legal se tivesse", "desejavel",
    "desejaveis", "nice to have", "nice-to-have", "preferred", "seria um plus", "e um plus", "bonus",
)
STOP_MARKERS = (
    "beneficios", "informacoes adicionais", "o que oferecemos", "what we offer", "benefits", "sobre a empresa",
    "about us",
)
MANDATORY_CUES = (
    "experiencia com", "experiencia em", "conhecimento em", "conhecimentos em", "dominio de", "vivencia com",
    "vivencia em", "familiaridade com", "proficiencia em", "experience with", "experience in", "knowledge of",
    "proficiency in", "required",
)
PREFERRED_CUES = (
    "diferencial", "desejavel", "nice to have", "preferred", "plus", "seria legal", "seria muito legal",
)
CONTEXT_CHARS = 520
TAIL_CHARS = 120
MIN_DESCRIPTION_CHARS = 120
UNKNOWN_CUE = (
    r"(?iuU)(?:experi[eê]ncia|conhecimento(?:s)?|dom[ií]nio|viv[eê]ncia|familiaridade|profici[eê]ncia)"
    r"\s+(?:com|em|de)\s+([^.;:\n]{2,170})"
)
UNKNOWN_SPLIT = r"(?iuU)\s*(?:,|;|\be\b|\band\b|\bou\b|\bor\b)\s*"
UNKNOWN_ADJECTIVE = r"(?iuU)^(?:bons?|boas?|forte|s[oó]lidos?|avançad[oa]s?|b[aá]sic[oa]s?)\s+"
UNKNOWN_GENERIC = (
    "experiencia", "conhecimento", "conhecimentos", "dominio", "vivencia", "familiaridade", "boa", "bom", "forte",
    "capacidade", "habilidade", "perfil", "atuacao", "area", "sistemas", "sistema", "ferramentas", "ferramenta",
    "tecnologia", "tecnologias", "processos", "processo", "ambiente", "ambientes", "clientes", "cliente", "time",
    "equipe", "dados", "aplicacoes", "solucoes", "gestao", "suporte", "desenvolvimento", "trabalho", "uso", "nivel",
    "leitura", "interpretacao", "analise",
)
GROUP_LIMITS = {"mandatory": 18, "preferred": 12, "context": 10, "manual": 6}

# --- fixed values: scoring --------------------------------------------------------------------------------------------------
LEVEL_SUPERSETS = {
    "english-basic": ("english-intermediate", "english-advanced", "english-fluent"),
    "english-intermediate": ("english-advanced", "english-fluent"),
    "english-advanced": ("english-fluent",),
    "spanish-intermediate": ("spanish-advanced",),
    "higher-education": ("higher-education-complete", "postgraduate"),
    "higher-education-complete": ("postgraduate",),
}
PHRASE_STOP_WORDS = (
    "a", "ao", "aos", "as", "com", "da", "das", "de", "do", "dos", "e", "em", "na", "nas", "no", "nos", "o", "os",
    "ou", "para", "por", "que", "se", "um", "uma", "the", "and", "or", "of", "to", "in", "with", "for", "on", "an",
    "at", "is", "are", "be", "as", "from",
)
PHRASE_SHARE = 0.72
FIT_LABELS = (
    (85, "Aderência muito forte"), (70, "Aderência forte"), (55, "Aderência parcial"), (0, "Aderência baixa"),
)
FIT_LABEL_UNSCORED = "Dados insuficientes para calcular aderência"

# --- fixed values: quality gates ------------------------------------------------------------------------------------------
SNAPSHOT_COLUMNS = (
    "title", "src", "cmp", "area", "sen", "wm", "mk", "co", "city", "pub", "seen", "exp", "url", "np", "sk", "smin",
    "smax", "cur", "pcd", "blind", "ct",
)
SNAPSHOT_DICTIONARIES = {
    "source": "src", "company": "cmp", "area": "area", "seniority": "sen", "work_model": "wm", "market": "mk",
    "country": "co", "currency": "cur",
}
SNAPSHOT_FORBIDDEN = ("description", "descricao", "requirements", "requisitos", "email", "phone")
STAGING_FORBIDDEN = ("description", "descriptionSummary", "about", "requirements")
STAGING_REQUIRED = ("id", "company", "title", "category", "seniority", "workplaceType", "location", "url")
STAGING_URL = r"(?i)^https://[a-z0-9-]+\.inhire\.app/vagas/"
EMAIL = r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"
PHONE = r"(?:\+?\d[\s().-]*){9,}"
META_LIMITS = {"t": 180, "e": 140, "l": 120, "w": 40, "d": 40}

# --- fixed values: career sites on one recruiting suite --------------------------------------------------------------------
SUITE_SITES = {
    "picpay": ("https://epdm.fa.la1.oraclecloud.com", "PicPay", "pt-BR", "PicPay"),
    "bancooriginal": ("https://epdm.fa.la1.oraclecloud.com", "BancoOriginal", "pt-BR", "Banco Original"),
    "braskem": ("https://epiw.fa.la1.oraclecloud.com", "CX_1", "pt-BR", "Braskem"),
    "gmfinancial": ("https://fa-exvu-saasfaprod1.fa.ocs.oraclecloud.com", "CX_1003", "pt-BR", "GM Financial"),
    "dell": ("https://iawmqy.fa.ocs.oraclecloud.com", "careers", "pt-BR", "Dell Technologies"),
    "arcelormittal": ("https://emfg.fa.em4.oraclecloud.com", "CX_4001", "pt-BR", "ArcelorMittal"),
    "grupomateus": ("https://fa-exvn-saasfaprod1.fa.ocs.oraclecloud.com", "CX_1", "pt-BR", "Grupo Mateus"),
    "autozone": ("https://egud.fa.us2.oraclecloud.com", "CX_1", "en", "AutoZone"),
    "nov": ("https://egay.fa.us6.oraclecloud.com", "CX_4001", "en", "NOV"),
    "arcorbrasil": ("https://emqm.fa.us6.oraclecloud.com", "NossasVagas", "pt-BR", "Arcor Brasil"),
}

# --- fixed values: board names ----------------------------------------------------------------------------------------------
REQUIRED_BOARDS = (
    ("c6bank", "C6 Bank", None),
    ("bees", "BEES", None),
    ("abinbev", "AB InBev | Growth Group", None),
    ("clara", "Clara", None),
    ("exame", "EXAME", True),
    ("xpinc", "XP Inc.", True),
    ("sertradingsa", "SERTRADING", True),
    ("elo", "Elo", True),
    ("arcoeducacao", "Arco Educação", True),
    ("gympass", "Wellhub", None),
    ("ilia", "ília", True),
    ("jusbrasil", "Jusbrasil", True),
    ("getnet", "Getnet", None),
    ("agilize", "Agilize", True),
    ("inter", "Inter", None),
)
CARD_PAGE_COMPANIES = {
    "full-sales-system": "Full Sales System",
    "singularis-rh": "Singularis RH",
    "singularis-rh/contratacaoacelerada": "Singularis RH",
    "rehva-tech": "Rehva Tech",
    "ataway-do-brasil": "Ataway do Brasil",
    "bm-vagas": "BM Vagas",
    "thera-consulting": "Thera Consulting",
    "fourhands-brasil": "Fourhands Brasil",
    "emiteai-solucoes-em-tecnologia": "Emiteai Soluções em Tecnologia",
    "grupo-regazzo": "Grupo Regazzo",
    "meirelespessoaseeducacao": "Meireles Pessoas e Educação",
    "luzcon-digital-ltda": "Luzcon Digital",
    "alpha-estagio": "Alpha Estágio",
    "3am-it-services-2": "3AM IT Services",
}
CATALOG_COMPANIES = {
    "vempratotvs": "TOTVS",
    "universoecommerce": "Universo E-commerce",
    "vidya": "Vidya",
    "grupobridger": "Grupo Bridger",
    "vagasolor": "Solor Tecnologia",
    "cesed": "CESED",
    "oncomed": "Oncomed",
    "bramoffshore": "Bram Offshore",
    "vagashtri": "HTRI",
    "trabalhenagnatus": "Gnatus",
    "einscricao": "eInscrição",
    "afin": "AFIN Assessoria Fiscal e Contábil",
    "vempratechfin": "Techfin",
    "estuda": "Estuda",
    "om30": "OM30",
    "vagaconfidencialbrasil": "Empresa confidencial",
    "facapartedogrupoconsulth": "Grupo Consulth",
    "concremat": "Concremat",
    "vagasavaeducacao": "AVA Educação",
    "selbetti": "Selbetti",
    "netratecnologia": "Netra Tecnologia",
    "vagasecomex": "eCOMEX",
}
BOARD_TITLES = {"ciandt": "CI&T", "nubank": "Nubank"}
ACCENTURE_LEVELS = {
    "early career": "Júnior/Assistente", "mid-level": "Pleno", "senior level": "Sênior/Especialista",
}
EXCLUDED_BOARDS = ("stone", "ifoodcarreiras")
SOURCES = (
    "inhire", "empregare", "experian", "abler", "recrutei", "totvs", "accenture", "bradesco", "gupy", "solides",
    "geekhunter", "github", "infojobs", "nerdin", "docusign", "dbccompany", "cloudwalk", "providerit", "fiserv",
    "metalfrio", "revolut", "inlog", "nestle", "stone", "ifood", "picpay", "bancooriginal", "braskem", "gmfinancial",
    "dell", "arcelormittal", "grupomateus", "autozone", "nov", "arcorbrasil", "themuse", "remotive", "jobicy",
    "remoteok", "himalayas", "workingnomads", "arbeitnow", "weworkremotely", "wise", "greenhouse", "lever", "ashby",
)

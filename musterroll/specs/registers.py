"""Specs of the twelve public registers and the daily short-position feed.

Fixed values: column keys, roles, types, source headers, enum aliases, units,
resource names and cadences below must equal what the published extracts and existing
queries use.  They are listed as they are.  Descriptions and keywords are our own.
"""

from __future__ import annotations

from musterroll.functions.regions import state_enum
from musterroll.specs.model import TableSpec, columns

TRUNCATION_SUFFIX = "...[cut here; leave out cut_text to see the full text]"
TRUNCATION_CHARS = 200

_WEEKLY = dict(
    cadence="weekly", cache_kind="register", period_coverage="current snapshot (weekly)"
)


def _same(*values: str) -> dict[str, str]:
    return {v: v for v in values}


COMPANIES = TableSpec(
    id="COMPANIES",
    name="Company Register",
    description="Every registered company with its number, type, status and registration dates.",
    keywords=(
        "incorporated entities", "corporation lookup", "limited companies",
        "australian company number", "wound up or struck off", "who incorporated when",
    ),
    discovery={"package": "companies", "resource_name": "Company Dataset - Current"},
    natural_key=("acn",),
    large=True,
    multiline=False,
    columns=columns("""
        company_name           id         string  Company Name
        acn                    id         string  ACN
        type                   dimension  string  Type
        class                  dimension  string  Class
        sub_class              dimension  string  Sub Class
        status                 dimension  string  Status
        registration_date      dimension  date    Date of Registration
        deregistration_date    dimension  date    Date of Deregistration
        state_of_registration  dimension  string  Previous State of Registration
        abn                    id         string  ABN
        current_name           id         string  Current Name
    """),
    enums={
        "status": {"registered": "REGD", "active": "REGD", "deregistered": "DRGD"}
        | _same("REGD", "DRGD"),
        "type": {"proprietary": "APTY", "pty": "APTY", "public": "APUB", "foreign": "RFCD"}
        | _same("APTY", "APUB", "RFCD"),
    },
    **_WEEKLY,
)

BUSINESS_NAMES = TableSpec(
    id="BUSINESS_NAMES",
    name="Business Names Register",
    description="Registered and cancelled business (trading) names and who holds them.",
    keywords=(
        "shop and brand names", "registered name of a business", "names held by a person or firm",
        "name renewal and cancellation", "storefront name",
    ),
    discovery={"package": "business-names", "resource_name": "Business Names Dataset - Current"},
    natural_key=("state_number", "business_name", "abn"),
    large=True,
    multiline=False,
    columns=columns("""
        register_name      dimension  string  REGISTER_NAME
        business_name      id         string  BN_NAME
        status             dimension  string  BN_STATUS
        registration_date  dimension  date    BN_REG_DT
        cancellation_date  dimension  date    BN_CANCEL_DT
        state_number       id         string  BN_STATE_NUM
        state              dimension  string  BN_STATE_OF_REG
        abn                id         string  BN_ABN
    """),
    enums={
        "state": state_enum(),
        "status": {"registered": "Registered", "active": "Registered", "cancelled": "Cancelled"}
        | _same("Registered", "Cancelled"),
    },
    **_WEEKLY,
)

FINANCIAL_ADVISERS = TableSpec(
    id="FINANCIAL_ADVISERS",
    name="Financial Advisers Register",
    description="People who give personal financial advice, one row per appointment.",
    keywords=(
        "people giving money advice", "investment planner", "adviser history",
        "qualifications of a planner", "who advised under which licence",
    ),
    discovery={
        "package": "financial-adviser",
        "resource_name": "Financial Advisers Dataset - Current",
    },
    natural_key=("adviser_number", "licence_number", "adv_start_date"),
    columns=columns("""
        register_name                   dimension  string  REGISTER_NAME
        adviser_name                    dimension  string  ADV_NAME
        adviser_number                  id         string  ADV_NUMBER
        adviser_role                    dimension  string  ADV_ROLE
        adviser_role_status             dimension  string  ADV_ROLE_STATUS
        adviser_abn                     dimension  string  ADV_ABN
        first_provided_advice           dimension  string  ADV_FIRST_PROVIDED_ADVICE
        licence_name                    dimension  string  LICENCE_NAME
        licence_number                  dimension  string  LICENCE_NUMBER
        licence_abn                     dimension  string  LICENCE_ABN
        adv_start_date                  dimension  date    ADV_START_DT
        adv_end_date                    dimension  date    ADV_END_DT
        overall_registration_status     dimension  string  OVERALL_REGISTRATION_STATUS
        registration_status_under_afsl  dimension  string  REGISTRATION_STATUS_UNDER_AFSL
        state                           dimension  string  ADV_ADD_STATE
        postcode                        dimension  string  ADV_ADD_PCODE
        country                         dimension  string  ADV_ADD_COUNTRY
        qualifications                  dimension  string  QUALIFICATIONS_AND_TRAINING
        memberships                     dimension  string  MEMBERSHIPS
    """),
    enums={
        "state": state_enum(),
        # the published extract says Registered / Not Registered; older ones Current / Ceased
        "overall_registration_status": {
            "registered": "Registered", "current": "Registered",
            "not registered": "Not Registered", "ceased": "Not Registered",
        }
        | _same("Registered", "Not Registered", "Current", "Ceased"),
        "adviser_role_status": {"current": "Current", "ceased": "Ceased"}
        | _same("Current", "Ceased"),
    },
    **_WEEKLY,
)

AFS_AUTH_REP = TableSpec(
    id="AFS_AUTH_REP",
    name="AFS Authorised Representative Register",
    description="Representatives who act under a financial services licence.",
    keywords=(
        "agents of a licence holder", "appointed on behalf of a licensee",
        "delegated financial services", "cross endorsement", "rep appointments",
    ),
    discovery={
        "package": "afs-authorised-representative",
        "resource_name": "AFS Authorised Representative Dataset - Current",
    },
    natural_key=("rep_number",),
    columns=columns("""
        register_name   dimension  string  REGISTER_NAME
        rep_number      id         string  AFS_REP_NUM
        licence_number  dimension  string  AFS_LIC_NUM
        rep_name        dimension  string  AFS_REP_NAME
        rep_abn         dimension  string  AFS_REP_ABN
        rep_acn         dimension  string  AFS_REP_ACN
        rep_other_role  dimension  string  AFS_REP_OTHER_ROLE
        rep_start_date  dimension  date    AFS_REP_START_DT
        rep_status      dimension  string  AFS_REP_STATUS
        rep_end_date    dimension  date    AFS_REP_END_DT
        locality        dimension  string  AFS_REP_ADD_LOCAL
        state           dimension  string  AFS_REP_ADD_STATE
        postcode        dimension  string  AFS_REP_ADD_PCODE
        country         dimension  string  AFS_REP_ADD_COUNTRY
        appointed_by    dimension  string  AFS_REP_APPOINTED_BY
    """),
    enums={
        "state": state_enum(),
        "rep_status": {"current": "Current", "ceased": "Ceased"} | _same("Current", "Ceased"),
    },
    **_WEEKLY,
)

AFS_LICENSEE = TableSpec(
    id="AFS_LICENSEE",
    name="Australian Financial Services Licensee Register",
    description="Holders of a financial services licence and what the licence authorises.",
    keywords=(
        "holders of a financial services permit", "licensed dealers and brokers",
        "licence conditions", "funds and platforms operator", "authorised financial business",
    ),
    discovery={"package": "afs-licensee", "resource_name": "AFS Licensee Dataset - Current"},
    natural_key=("licence_number",),
    truncate={"authorisation": TRUNCATION_CHARS},
    columns=columns("""
        register_name   dimension  string  REGISTER_NAME
        licence_number  id         string  AFS_LIC_NUM
        licensee_name   dimension  string  AFS_LIC_NAME
        abn_acn         dimension  string  AFS_LIC_ABN_ACN
        start_date      dimension  date    AFS_LIC_START_DT
        pre_fsr         dimension  string  AFS_LIC_PRE_FSR
        locality        dimension  string  AFS_LIC_ADD_LOCAL
        state           dimension  string  AFS_LIC_ADD_STATE
        postcode        dimension  string  AFS_LIC_ADD_PCODE
        country         dimension  string  AFS_LIC_ADD_COUNTRY
        latitude        dimension  string  AFS_LIC_LAT
        longitude       dimension  string  AFS_LIC_LNG
        authorisation   dimension  string  AFS_LIC_CONDITION
    """),
    enums={"state": state_enum()},
    **_WEEKLY,
)

CREDIT_LICENSEE = TableSpec(
    id="CREDIT_LICENSEE",
    name="Australian Credit Licensee Register",
    description="Holders of a consumer credit licence and its status history.",
    keywords=(
        "holders of a lending permit", "licensed lenders",
        "home loan and consumer lending business", "credit business conditions", "loan company",
    ),
    discovery={"package": "credit-licensee", "resource_name": "Credit Licence Dataset - Current"},
    natural_key=("licence_number",),
    columns=columns("""
        register_name   dimension  string  REGISTER_NAME
        licence_number  id         string  CRED_LIC_NUM
        licensee_name   dimension  string  CRED_LIC_NAME
        start_date      dimension  date    CRED_LIC_START_DT
        end_date        dimension  date    CRED_LIC_END_DT
        current_status  dimension  string  CRED_LIC_STATUS
        abn_acn         dimension  string  CRED_LIC_ABN_ACN
        afsl_number     dimension  string  CRED_LIC_AFSL_NUM
        status_history  dimension  string  CRED_LIC_STATUS_HISTORY
        locality        dimension  string  CRED_LIC_LOCALITY
        state           dimension  string  CRED_LIC_STATE
        postcode        dimension  string  CRED_LIC_PCODE
        edrs            dimension  string  CRED_LIC_EDRS
        business_name   dimension  string  CRED_LIC_BN
        authorisations  dimension  string  CRED_LIC_AUTHORISATIONS
    """),
    enums={
        "state": state_enum(),
        "current_status": {
            "approved": "APPR", "current": "APPR", "active": "APPR",
            "cancelled": "CANC", "suspended": "SUSP",
        }
        | _same("APPR", "CANC", "SUSP"),
    },
    **_WEEKLY,
)

CREDIT_REPRESENTATIVE = TableSpec(
    id="CREDIT_REPRESENTATIVE",
    name="Credit Representative Register",
    description="Representatives who act under a consumer credit licence.",
    keywords=(
        "agents of a lender", "loan broker", "appointed for a credit licence holder",
        "person arranging loans", "credit appointments",
    ),
    discovery={
        "package": "credit-representative",
        "resource_name": "Credit Representative Dataset - Current",
    },
    natural_key=("rep_number",),
    columns=columns("""
        register_name      dimension  string  REGISTER_NAME
        rep_number         id         string  CRED_REP_NUM
        licensee_number    id         string  CRED_LIC_NUM
        rep_name           id         string  CRED_REP_NAME
        abn_acn            dimension  string  CRED_REP_ABN_ACN
        start_date         dimension  date    CRED_REP_START_DT
        end_date           dimension  date    CRED_REP_END_DT
        locality           dimension  string  CRED_REP_LOCALITY
        state              dimension  string  CRED_REP_STATE
        postcode           dimension  string  CRED_REP_PCODE
        edrs               dimension  string  CRED_REP_EDRS
        authorisations     dimension  string  CRED_REP_AUTHORISATIONS
        cross_endorsement  dimension  string  CRED_REP_CROSS_ENDORSE
    """),
    enums={"state": state_enum()},
    **_WEEKLY,
)

BANNED_PERSONS = TableSpec(
    id="BANNED_PERSONS",
    name="Banned and Disqualified Persons Register",
    description="People banned or disqualified, with the type and term of the ban.",
    keywords=(
        "people barred from the industry", "individual bans", "barred from managing companies",
        "banned individual", "regulatory action against a person",
    ),
    discovery={
        "package": "banned-disqualified-per",
        "resource_name": "Banned and Disqualified Persons - Current",
    },
    natural_key=("doc_number",),
    columns=columns("""
        register_name  dimension  string  REGISTER_NAME
        person_name    dimension  string  BD_PER_NAME
        ban_type       dimension  string  BD_PER_TYPE
        doc_number     id         string  BD_PER_DOC_NUM
        start_date     dimension  date    BD_PER_START_DT
        end_date       dimension  date    BD_PER_END_DT
        locality       dimension  string  BD_PER_ADD_LOCAL
        state          dimension  string  BD_PER_ADD_STATE
        postcode       dimension  string  BD_PER_ADD_PCODE
        country        dimension  string  BD_PER_ADD_COUNTRY
        comments       dimension  string  BD_PER_COMMENTS
    """),
    enums={"state": state_enum()},
    **_WEEKLY,
)

BANNED_ORGS = TableSpec(
    id="BANNED_ORGS",
    name="Banned and Disqualified Organisations Register",
    description="Organisations banned or disqualified, with the type and term of the ban.",
    keywords=(
        "firms barred from the industry", "organisation bans", "barred business", "banned entity",
        "regulatory action against a firm",
    ),
    discovery={
        "package": "banned-disqualified-org",
        "resource_name": "Banned and Disqualified Organisations - Current",
    },
    natural_key=("acn",),
    columns=columns("""
        register_name  dimension  string  REGISTER_NAME
        acn            id         string  BD_ORG_ACN
        org_name       dimension  string  BD_ORG_NAME
        ban_type       dimension  string  BD_ORG_TYPE
        url            dimension  string  BD_ORG_URL
        start_date     dimension  date    BD_ORG_START_DT
        end_date       dimension  date    BD_ORG_END_DT
        comments       dimension  string  BD_ORG_COMMENT
    """),
    **_WEEKLY,
)

LIQUIDATOR = TableSpec(
    id="LIQUIDATOR",
    name="Registered Liquidator Register",
    description="Registered and official liquidators, their firm and status.",
    keywords=(
        "winding up specialist", "insolvent company administrator",
        "person closing a failed company", "receivers and administrators",
        "insolvency appointments",
    ),
    discovery={"package": "liquidator", "resource_name": "Liquidator Dataset - Current"},
    natural_key=("liquidator_number",),
    columns=columns("""
        register_name                   dimension  string  REGISTER_NAME
        liquidator_number               id         string  LIQ_NUM
        official_liquidator_number      dimension  string  OFF_LIQ_NUM
        liquidator_name                 dimension  string  LIQ_NAME
        liquidator_start_date           dimension  date    LIQ_START_DT
        official_liquidator_start_date  dimension  date    OFF_LIQ_START_DT
        current_status                  dimension  string  LIQ_STATUS
        suspended_date                  dimension  date    LIQ_SUSP_DT
        locality                        dimension  string  LIQ_ADD_LOCAL
        state                           dimension  string  LIQ_ADD_STATE
        postcode                        dimension  string  LIQ_ADD_PCODE
        country                         dimension  string  LIQ_ADD_COUNTRY
        firm                            dimension  string  LIQ_FIRM
    """),
    enums={
        "state": state_enum(),
        "current_status": {
            "approved": "APPR", "current": "APPR", "active": "APPR",
            "suspended": "SUSP", "disqualified": "DISQ", "expired": "EXPI",
        }
        | _same("APPR", "SUSP", "DISQ", "EXPI"),
    },
    **_WEEKLY,
)

AUDITORS = TableSpec(
    id="AUDITORS",
    name="Registered Auditor Register",
    description="Registered company auditors and their registration status.",
    keywords=(
        "approved company auditors", "people who audit accounts", "audit practitioner",
        "suspended or cancelled auditors", "financial report audit",
    ),
    discovery={
        "package": "registered-auditor",
        "resource_name": "Registered Auditor Dataset - Current",
    },
    natural_key=("auditor_number",),
    columns=columns("""
        register_name      dimension  string  REGISTER_NAME
        auditor_number     id         string  REG_AUD_NUM
        auditor_name       id         string  REG_AUD_NAME
        acn                id         string  REG_AUD_ACN
        registration_date  dimension  date    REG_AUD_START_DT
        current_status     dimension  string  REG_AUD_STATUS
        suspension_date    dimension  date    REG_AUD_SUSP_DT
        locality           dimension  string  REG_AUD_ADD_LOCAL
        state              dimension  string  REG_AUD_ADD_STATE
        postcode           dimension  string  REG_AUD_ADD_PCODE
        country            dimension  string  REG_AUD_ADD_COUNTRY
    """),
    enums={
        "state": state_enum(),
        "current_status": {
            "registered": "REGD", "active": "REGD", "cancelled": "CANC", "suspended": "SUSP",
        }
        | _same("REGD", "CANC", "SUSP"),
    },
    **_WEEKLY,
)

SMSF_AUDITORS = TableSpec(
    id="SMSF_AUDITORS",
    name="Self-Managed Super Fund Auditor Register",
    description="Auditors of self-managed super funds, one row per condition or capacity.",
    keywords=(
        "auditors of private pension funds", "self run superannuation",
        "super fund audit approval", "smsf conditions", "retirement fund auditor",
    ),
    discovery={"package": "smsf", "resource_name": "SMSF Auditor Dataset - Current"},
    natural_key=("smsf_auditor_number", "attribute_type", "capacity", "condition"),
    columns=columns("""
        register_name         dimension  string  REGISTER_NAME
        smsf_auditor_number   id         string  SMSF_NUM
        auditor_name          id         string  SMSF_NAME
        current_status        dimension  string  SMSF_STATUS
        abn                   id         string  SMSF_PERSON_ABN
        registration_date     dimension  date    SMSF_REG_DT
        suspension_start      dimension  date    SMSF_SUSP_START_DT
        suspension_end        dimension  date    SMSF_SUSP_END_DT
        locality              dimension  string  SMSF_LOCALITY
        postcode              dimension  string  SMSF_POST_CODE
        state                 dimension  string  SMSF_STATE
        attribute_type        dimension  string  SMSF_ATTRIBUTE_TYPE
        capacity              dimension  string  SMSF_CAPACITY
        capacity_firm_name    id         string  SMSF_CAPACITY_FIRM_NAME
        capacity_start_date   dimension  date    SMSF_CAPACITY_START_DT
        condition             dimension  string  SMSF_CONDITION
        condition_detail      dimension  string  SMSF_CONDITION_DTL
        condition_start_date  dimension  date    SMSF_CONDITION_START_DT
    """),
    enums={
        "state": state_enum(),
        "current_status": {
            "registered": "Registered", "active": "Registered",
            "suspended": "Suspended", "cancelled": "Cancelled",
        }
        | _same("Registered", "Suspended", "Cancelled"),
    },
    **_WEEKLY,
)

SHORT_POSITIONS = TableSpec(
    id="SHORT_POSITIONS",
    name="Daily Aggregated Short Position Report",
    description="Reported short positions per listed product, one file per trading day.",
    keywords=(
        "shares sold short", "bets against a share", "most heavily shorted securities",
        "daily short sale totals", "percentage of issue shorted",
    ),
    cadence="daily",
    cache_kind="data",
    period_coverage="daily file",
    file_template="RR{date:yyyyMMdd}-001-SSDailyAggShortPos.csv",
    lookback_days=10,
    natural_key=("product_code",),
    columns=columns("""
        product                   id       string  Product
        product_code              id       string  Product Code
        reported_short_positions  measure  long    Reported Short Positions                              Shares
        total_product_in_issue    measure  long    Total Product in Issue                                Shares
        short_percent             measure  double  % of Total Product in Issue Reported as Short Positions  Per cent
    """),
)

REGISTERS = (
    COMPANIES,
    BUSINESS_NAMES,
    FINANCIAL_ADVISERS,
    AFS_AUTH_REP,
    AFS_LICENSEE,
    CREDIT_LICENSEE,
    CREDIT_REPRESENTATIVE,
    BANNED_PERSONS,
    BANNED_ORGS,
    LIQUIDATOR,
    AUDITORS,
    SMSF_AUDITORS,
    SHORT_POSITIONS,
)

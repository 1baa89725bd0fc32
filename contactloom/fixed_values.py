"""Fixed values.

Everything here is data: words, codes and patterns that appear in the tables the jobs read, or
labels that consumers of the results look for.  They must be spelled exactly like this for the
results to be right, misspellings included.  Logic lives elsewhere and takes these as arguments.
"""

from __future__ import annotations

# ---- sentinels ------------------------------------------------------------------------------
UNKNOWN_ID = "-1"
NEVER = "9999-12-31"
PERSON_PREFIX = "LH"
ACCOUNT_PREFIX = "VNID"

# ---- therapeutic areas ------------------------------------------------------------------------
AREA_MS = "MULTIPLE SCLEROSIS"
AREA_SMA = "SPINAL MUSCULAR ATROPHY"
AREA_ALZ = "ALZHEIMER’S DISEASE"
FRANCHISE_NEURO = "FRANCHISE NEUROLOGY"
HEM_PARENT_AREAS = ["HEMOPHILIA", "HEMATOLOGY"]
MS_PARENT_AREAS = ["NEUROLOGY", "MULTIPLE SCLEROSIS", "CNS"]
PARENT_AREAS = ["NEUROLOGY", "HEMATOLOGY"]
MARKET_AREAS = [AREA_MS, AREA_SMA]

# ---- product names as stored in the data ------------------------------------------------------
MS_BRANDS = ["AVONEX", "PLEGRIDY", "TECFIDERA", "TYSABRI", "VUMERITY", "ZINBRYTA", "TECFIDERA CORE"]
SMA_BRANDS = ["SPINRAZA"]
ALZ_BRANDS = ["ADUHELM", "ADUCANUMAB"]
ALZ_PRODUCT = "ADUHELM"
MS_PROGRAM = "ABOVE MS"
SMA_PROGRAM = "TOGETHER IN SMA"
MS_NEW_BRAND = "VUMERITY"
SMA_DRUG = "SPINRAZA"
MARKETED_PRODUCTS = ["AVONEX", "PLEGRIDY", "TYSABRI", "TECFIDERA", "VUMERITY",
                     "MULTIPLE SCLEROSIS", "SPINAL MUSCULAR ATROPHY", "SPINRAZA"]
OPT_PROGRAMS = ["AVONEX", "PLEGRIDY", "TECFIDERA", "TYSABRI", "VUMERITY",
                "ABOVE MS", "SPINRAZA", "TOGETHER IN SMA"]
FRANCHISE_PRODUCT = {"FRANCHISE PEP": "PLEGRIDY"}
SMA_WEB_SITES = {"SPINRAZA": "SPINRAZA.COM", "TOGETHER IN SMA": "TOGETHERINSMA.COM"}
# output column stem -> product name, for the trailing-unit measures
UNIT_BRANDS = {"tecfidera": "TECFIDERA", "tysabri": "TYSABRI", "plegridy": "PLEGRIDY",
               "avonex": "AVONEX", "vumerity": "VUMERITY"}
# output column -> column stem of its trailing units
WRITER_INDICATORS = {"market_writer_indicator": "ms", "biogen_writer_indicator": "biib",
                     "tecfidera_writer_indicator": "tecfidera", "tysabri_writer_indicator": "tysabri",
                     "plegridy_writer_indicator": "plegridy", "avonex_writer_indicator": "avonex",
                     "vumerity_writer_indicator": "vumerity"}
# table of engagement scores -> output column
ENGAGEMENT_SCORES = {"engagement_score_tec": "tecfidera_customer_engagement_score",
                     "engagement_score_tys": "tysabri_customer_engagement_score"}
# measures kept at the shorter window
SHORT_WINDOW_UNITS = ["ms_units_6_months", "biib_units_6_months", "tecfidera_units_6_months"]

# ---- codes -------------------------------------------------------------------------------------
RECORD_STATE_DOMAIN = "Record State"
RECORD_STATES_FIRST_RUN = ["ACTIVE"]
RECORD_STATES_LATER_RUNS = ["ACTIVE", "INACTIVE", "DELETED"]
FIRST_RUN_DATE = "2014-01-01"
AMA_FLAG = "AMA_DO_NOT_CONTACT_FLG"
RECORD_STATE_LETTERS = {"ACTIVE": "A", "DELETED": "D", "INACTIVE": "I"}
HCP_DATE_PARAM = "ETL_US_PM_DATE_PARAM_EXTGT_OUT_PARTY_HCP"
MARKET_DATE_PARAM = "ETL_US_PM_DATE_PARAM_EXTGT_OUT_PARTY_MKT"
MERGE_DATE_PARAM = "ETL_US_PM_DATE_PARAM_EXTGT_OUT_SRC_MDM_MERGE"
BOUNCE_ACTIVITY_TYPE = 245
PRESCRIBER_TYPES = ["Non-Prescribing Health Care Professional", "Prescriber"]
PATIENT_CLASSES = ["Patient/Caregiver", "Contact", "Caregiver", "Patient"]
MINOR_SEGMENTS = ["Adolscent Patient", "Pediatric Patient"]
LEAD_TYPE = "Patient Lead Type"
FIELD_FORCES = ["AD", "AD-AAL", "AD-ADRM", "AD-MSL", "AD-TBM"]
FIELD_FORCES_CALLS = ["AD", "AD-AAL", "AD-ADRM", "AD-MSL", "AD-TBM", "AD MSL"]
FIELD_FORCES_REPS = ["AD-AAL", "AD-ADRM", "AD-MSL", "AD-TBM"]
HEALTH_SYSTEM_TYPES = ["4:37", "26:13"]
TARGET_GROUPS = ["A", "B", "C", "D", "NEW"]
RESEND_SOURCES = ["SFDC_US", "SFDC_EU", "SFMC"]

# ---- blocked mail domains, matched on the upper-cased address ---------------------------------
BLOCKED_DOMAINS = ["%KP.ORG%", "%KAISERPERMANENTE%", "%KPCHR%", "%KPEXPERIENCE.NET%",
                   "%KPONLINE.ORG%", "%KAISERPERMANENTEJOBS.ORG%", "%KPPP.COM%"]

# ---- suppression labels -------------------------------------------------------------------------
EMAILABLE = "Emailable Record"
BAD_EMAIL = "Blank/Invalid Email Address"
BLOCKED = "Kaiser Suppression"
MERGED = "Merged Record"
HELD = "Held Record"
OPT_OUT_SUFFIX = " Opt Out"
STATUS_INACTIVE = "Status Inactive"
STATE_INACTIVE = "Record State Inactive"
AMA_OPT_OUT = "AMA Opt Out"
NON_PRESCRIBERS = "Non Prescribers"
FEED_ORIGIN = "Feed Origin Suppression"
PARTY_TYPE = "Party Type Suppression"
PATIENT_CLASS = "Patient Class Suppression"
SUPPRESSED = "Suppressed Record"
INVALID_AGE = "Invalid Age"
PARTY_REASONS_PROFESSIONAL = [STATE_INACTIVE, STATUS_INACTIVE, NON_PRESCRIBERS, AMA_OPT_OUT,
                              BAD_EMAIL, BLOCKED]
PARTY_REASONS_PATIENT = [STATE_INACTIVE, FEED_ORIGIN, PARTY_TYPE, PATIENT_CLASS, SUPPRESSED,
                         BAD_EMAIL, INVALID_AGE]
CLAMP_PROFESSIONAL = [BAD_EMAIL, BLOCKED]
CLAMP_PATIENT = [BAD_EMAIL, INVALID_AGE, BLOCKED]
SOURCE_OPT, SOURCE_MERGE, SOURCE_BOUNCE = "Opt table", "Merge Table", "Bounce Table"
SOURCE_PARTY, SOURCE_NONE = "Party Table", "No Suppression"

# ---- tactic code shapes (LIKE patterns, '!' escapes the underscore) ----------------------------
TACTIC_CAMPAIGN = "%-%-%!_%"
TACTIC_CAMPAIGN_RESEND = "%-%-%!_R%"
TACTIC_HOUSE = "%BIOGEN-%!_%"
TACTIC_HOUSE_RESEND = "%BIOGEN-%!_%R%"
TACTIC_HOUSE_ANY = "%BIOGEN-%"
UNSUBSCRIBE_URLS = ["%UNSUBSCRIBE%", "%BIOGENPREFERENCECENTER%"]

# ---- affiliation labels --------------------------------------------------------------------------
AFFILIATION_COLUMNS = ["ad_primary_affiliation__c", "ad_infusion_treatment_location__c",
                       "ad_lp_scan_location__c", "ad_mri_scan_location__c",
                       "ad_neurocognitive_testing_location__c", "ad_pet_scan_location__c"]
AFFILIATION_SITES = {"AD_INFUSION_TREATMENT_LOCATION__C": "INFUSION TREATMENT",
                     "AD_PET_SCAN_LOCATION__C": "PET SCAN",
                     "AD_NEUROCOGNITIVE_TESTING_LOCATION__C": "NEUROCOGNITIVE TESTING",
                     "AD_MRI_SCAN_LOCATION__C": "MRI SCAN",
                     "AD_LP_SCAN_LOCATION__C": "LP SCAN"}
AFFILIATION_RANKS = {"PRIMARY__C": "PRIMARY", "SECONDARY__C": "SECONDARY"}

# ---- metric ids ----------------------------------------------------------------------------------
METRICS = {"M101": "HCP_Number_of_AB_Positive_Test_Result_Sponsored_Testing",
           "M102": "HCP_Number_of_AB_Negative_Test_Result_Sponsored_Testing",
           "M103": "HCP_Last_Call_Activity_Date",
           "M104": "HCO_Number_Of_Aduhelm_Shipment",
           "M105": "HCP_REP_Last_Called_Date"}

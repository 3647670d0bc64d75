"""Values that must equal those of the connected systems for right results.

They are field names, codes and defaults of the study's forms, written out in their natural
order. Jobs take them as defaults; another study passes its own.
"""

from recordflow.operators.reshape import Pairing
from recordflow.operators.select import CodeList, Range

# ---- form status and code lists: label → code ----
COMPLETE = {"Incomplete": "0", "Unverified": "1", "Complete": "2"}

GUARDIAN2_CONSENT = CodeList(
    "guardian2_consent",
    {
        "No": "0",
        "Yes": "1",
        "Yes, but email not yet available": "2",
        "Not Applicable (Adult Participant)": "3",
    },
)
SECOND_GUARDIAN_COMPLETE = CodeList(
    "complete_parent_second_guardian_consent",
    {**COMPLETE, "Not Required": "3", "Not Applicable (Adult Participant)": "4"},
)
# The labels of the next two lists that name the study or its app end before that name.
INTAKE_READY = CodeList("intake_ready", {"Not sent": "0", "Ready to Send": "1", "Participant information already sent": "2"})
ENROLLMENT_COMPLETE = CodeList(
    "enrollment_complete",
    {"Not Sent": "0", "Ready to Send": "1", "Parent and Participant information already sent": "2"},
)
AUDIOVIDEO = CodeList(
    "permission_audiovideo_participant",
    {
        "Not Applicable: no assent required": "0",
        "YES, you may record me during participation": "1",
        "NO, you may not record me during participation": "2",
    },
)
INVITATION_STATUS = CodeList("invite_status", {"not_invited": "1", "pending": "2", "invited": "3"})

# ---- age range in which the participant is asked for assent ----
ASSENT_AGE = Range(11, 18, left_inclusive=True, right_inclusive=False)

# ---- intake → operations: field renames ----
INTAKE_RENAMES = {
    "additional_1821": "additional",
    "address1_1821": "address1",
    "address2": "address_2",
    "aptnumber": "aptnumber1",
    "aptnumber_1821": "aptnumber1",
    "aptnumber_2": "aptnumber_2",
    "aptnumber_2_1821": "aptnumber_2",
    "city": "city1",
    "city_1821": "city1",
    "city_2_1821": "city_2",
    "parent_second_guardian_consent_complete": "complete_parent_second_guardian_consent",
    "dob_1821": "dob",
    "email_1821": "email",
    "email_2_1821": "email_2",
    "consent1": "first_name",
    "consent1_1821": "first_name",
    "gender_1821": "gender",
    "gender_other_1821": "gender_other",
    "genderpronoun_1821": "genderpronoun",
    "genderpronounother_1821": "genderpronounother",
    "genderpronoun_2_1821": "genderpronoun_parent1",
    "genderpronoun_parent2": "genderpronoun_parent2",
    "genderpronoun_parent2_1821": "genderpronoun_parent2",
    "par_rel": "guardian_relation",
    "par_rel_2": "guardian_relation_2",
    "consent5": "last_name",
    "consent5_1821": "last_name",
    "middlename_2_1821": "middlename_y",
    "parent_last_name_2_1821": "parent_last_name_2",
    "parentfirstname_1821": "parentfirstname",
    "parentfirstname_2_1821": "parentfirstname_2",
    "parent_last_name": "parentlastname",
    "parent_last_name_1821": "parentlastname",
    "permission_audiovideo_1113": "permission_audiovideo_participant",
    "permission_audiovideo_1417": "permission_audiovideo_participant",
    "permission_audiovideo_1821": "permission_audiovideo_participant",
    "permission_collab_1821": "permission_collab",
    "phone_1821": "phone",
    "phone_2_1821": "phone_2",
    "prefname_1821": "prefname",
    "biosex": "sex",
    "biosex_1821": "sex",
    "q_devices_1821": "q_devices",
    "q_devices_info_1821": "q_devices_info",
    "q_silverallergy_1821": "q_silverallergy",
    "sibling_1821": "sibling",
    "siblingdob_1821": "siblingdob",
    "siblingfirstname_1821": "siblingfirstname",
    "siblinglastname_1821": "siblinglastname",
    "state": "state1",
    "state_1821": "state1",
    "state_2_1821": "state_2",
    "zipcode": "zipcode1",
    "zipcode_1821": "zipcode1",
    "zipcode_2_1821": "zipcode_2",
}

# ---- intake → operations: prefixes of the fields that are taken over ----
INTAKE_PREFIXES = [
    "additional",
    "address1",
    "address_2",
    "adult_address",
    "adult_apt",
    "adult_city",
    "adult_email",
    "adult_phone",
    "adult_state",
    "adult_zip",
    "aptnumber1",
    "aptnumber_2",
    "ci_date",
    "ci_forms_due",
    "city1",
    "city_2",
    "complete_parent_second_guardian_consent",
    "dob",
    "email",
    "email_2",
    "enroll_date",
    "first_name",
    "futurecontact",
    "futurecontact_2",
    "gender",
    "gender_other",
    "genderpronoun",
    "genderpronoun_parent1",
    "genderpronoun_parent2",
    "genderpronounother",
    "guardian2_consent_due",
    "guardian_relation",
    "guardian_relation_2",
    "guardian_relation_other",
    "guardian_relation_other_2",
    "last_name",
    "middlename_y",
    "mrn",
    "parent_involvement",
    "parent_last_name_2",
    "parentfirstname",
    "parentfirstname_2",
    "parentlastname",
    "permission_audiovideo",
    "permission_audiovideo_participant",
    "permission_collab",
    "phone",
    "phone_2",
    "prefname",
    "q_devices",
    "q_devices_info",
    "q_silverallergy",
    "record_id",
    "role_consent",
    "same_address",
    "sex",
    "sibling",
    "siblingdob",
    "siblingfirstname",
    "siblinglastname",
    "state1",
    "state_2",
    "zipcode1",
    "zipcode_2",
]

# ---- operations → app accounts: columns of an account with their defaults ----
CHILD_ACCOUNT = {
    "nickname": None,
    "role": "respondent",
    "tag": "Child",
    "accountType": "limited",
    "email": None,
    "firstName": None,
    "lastName": None,
    "secretUserId": None,
    "language": "en",
    "parent_involvement": None,
    "password": None,
}
PARENT_ACCOUNT = {
    "email": None,
    "nickname": None,
    "role": "respondent",
    "tag": "Parent",
    "accountType": "full",
    "firstName": None,
    "lastName": None,
    "secretUserId": None,
    "language": "en",
    "parent_involvement": None,
}
PARENT_RENAMES = {
    "email_1821": "email",
    "parentfirstname": "firstName",
    "parentlastname": "lastName",
    "r_id": "secretUserId",
}


def child_renames(app: str) -> dict[str, str]:
    """Renames of a child account; two of the fields carry the app's name."""
    return {
        f"{app}_email_child": "email",
        "email": "_parent_email",
        "prefname": "nickname",
        "first_name": "firstName",
        "last_name": "lastName",
        f"{app}_password_child": "password",
        "mrn": "secretUserId",
    }


# ---- consent → responder tracking: who answers for whom ----
_CHILD = {"dob": "child_dob", "consent1": "child_fname", "mrn": "mrn"}
_ADULT = {"dob_1821": "child_dob", "consent1_1821": "child_fname", "mrn": "mrn"}
RESPONDER_PAIRINGS = [
    Pairing(
        {
            "email": "resp_email",
            "parentfirstname": "resp_fname",
            "parent_last_name": "resp_lname",
            "phone": "resp_phone",
        },
        _CHILD,
        "child",
    ),
    Pairing(
        {
            "email_2": "resp_email",
            "parentfirstname_2": "resp_fname",
            "parent_last_name_2": "resp_lname",
            "phone_2": "resp_phone",
        },
        _CHILD,
        "child",
    ),
    Pairing(
        {
            "email_1821": "email",
            "parentfirstname_1821": "resp_fname",
            "parent_last_name_1821": "resp_lname",
            "phone_1821": "resp_phone",
        },
        _ADULT,
        "adult",
    ),
    Pairing(
        {
            "email_2_1821": "resp_email",
            "parentfirstname_2_1821": "resp_fname",
            "parent_last_name_2_1821": "resp_lname",
            "phone_2_1821": "resp_phone",
        },
        _ADULT,
        "adult",
    ),
]
# ---- end of fixed values ----

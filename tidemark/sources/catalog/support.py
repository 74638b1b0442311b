"""Tables of a Zendesk account.

No table names a mode, so all run as cdc. Comments come out of ticket events; the
ticket they belong to and the event that carried them are kept.
"""

from pyspark.sql import types as T

from tidemark.model import TableDef
from tidemark.sources.catalog.fields import fields

# Table schemas, response keys, and the child event taken as a comment.
_NAMED = {"maps": T.ArrayType(T.MapType(T.StringType(), T.StringType()))}
_SCHEMAS = {
    "tickets": """id:long url external_id via:map created_at updated_at type subject raw_subject
        description priority status recipient requester_id:long submitter_id:long assignee_id:long
        organization_id:long group_id:long collaborator_ids:[long] follower_ids:[long]
        email_cc_ids:[long] forum_topic_id:long problem_id:long has_incidents:boolean is_public:boolean
        due_at tags:[string] custom_fields:maps satisfaction_rating:map sharing_agreement_ids:[long]
        fields:maps followup_ids:[long] ticket_form_id:long brand_id:long allow_channelback:boolean
        allow_attachments:boolean from_messaging_channel:boolean generated_timestamp:long""",
    "organizations": """id:long url external_id name created_at updated_at domain_names:[string] details
        notes group_id:long shared_tickets:boolean shared_comments:boolean tags:[string]
        organization_fields:map""",
    "articles": """id:long url html_url author_id:long comments_disabled:boolean draft:boolean
        promoted:boolean position:long vote_sum:long vote_count:long section_id:long created_at updated_at
        name title source_locale locale outdated:boolean outdated_locales:[string] edited_at
        user_segment_id:long permission_group_id:long content_tag_ids:[long] label_names:[string] body""",
    "brands": """id:long url name brand_url subdomain host_mapping has_help_center:boolean
        help_center_state active:boolean default:boolean is_deleted:boolean created_at updated_at
        ticket_form_ids:[long] signature_template""",
    "groups": """id:long url name deleted:boolean created_at updated_at description default:boolean
        is_public:boolean""",
    "ticket_comments": """id:long event_id:long ticket_id:long type request_id:long requester_id:long
        status subject priority organization_id:long description body author_id:long created_at updated_at
        assignee_id:long group_id:long collaborator_ids:[long] custom_fields:maps email_cc_ids:[long]
        follower_ids:[long] ticket_form_id:long brand_id:long comments:maps""",
    "topics": """id:long url html_url name description position:long follower_count:long
        community_id:long created_at updated_at user_segment_id:long manageable_by
        user_segment_ids:[long]""",
    "users": """id:long url email name active:boolean alias created_at custom_role_id:long
        default_group_id:long details external_id iana_time_zone last_login_at locale locale_id:long
        moderator:boolean notes only_private_comments:boolean organization_id:long phone photo:map
        report_csv:boolean restricted_agent:boolean role role_type:long shared:boolean
        shared_agent:boolean shared_phone_number:boolean signature suspended:boolean tags:[string]
        ticket_restriction time_zone two_factor_auth_enabled:boolean updated_at user_fields:map
        verified:boolean""",
}
_ENVELOPES = {"ticket_comments": "ticket_events"}

TABLES = {
    name: TableDef(
        name,
        fields(text, _NAMED),
        keys=("id",),
        cursor="updated_at",
        envelope=_ENVELOPES.get(name, name),
        events=name == "ticket_comments",
    )
    for name, text in _SCHEMAS.items()
}
